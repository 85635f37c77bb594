"""cohortlens — segmentation analytics as Spark DataFrame operators.

Layout:
  sources/    reading, schema checks, role mapping, sinks
  functions/  column-expression helpers (bands, rule tables, formatting, distances)
  operators/  cleaning, statistics, scaling, clustering, metrics, profiles, chart tables
  plans/      the query catalogue, its DuckDB twins, and the end-to-end run
  streaming/  scoring a stream against a fitted centroid model
"""

from cohortlens.config import Roles, Bands, SegmentationConfig  # noqa: F401
from cohortlens.session import get_session, ensure_checkpoint_dir  # noqa: F401
