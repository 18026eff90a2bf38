"""tabqual: Spark-native data quality, profiling and curation.

Every operator is a plain function ``DataFrame -> DataFrame`` (or a Spark ML
stage) that runs on the cluster; nothing is collected to the driver except
scalar thresholds and column lists.
"""

from tabqual.session import get_session, shared_path

__all__ = ["get_session", "shared_path"]
