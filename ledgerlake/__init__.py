"""ledgerlake: a retail analytics warehouse written natively for PySpark.

Layers (all lazy DataFrame plans, materialised to Parquet by the pipeline):

* bronze  - raw CSV extracts as all-string frames with lineage
* silver  - typed, normalised, flagged (bad and duplicate rows are kept)
* gold    - conformed dimensions and fact tables
* views   - KPI views, sample queries, metrics and business questions
"""

from ledgerlake.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
