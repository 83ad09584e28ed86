"""tickforge: open-high-low-close-volume bars as lazy Spark DataFrame jobs.

Sub-packages:

* ``functions``  - ``Column -> Column`` helpers (time, symbols, numbers, JSON)
* ``operators``  - ``DataFrame -> DataFrame`` steps (derive bars, landing,
  pairs, holidays, quality checks)
* ``sources``    - readers for landed Parquet and landed API responses
* ``sinks``      - Parquet / text writers
* ``plans``      - whole jobs composed from the above, join helpers
"""

from tickforge.session import ensure_utc, get_session, scratch_path, sizing_conf  # noqa: F401
