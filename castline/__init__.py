"""castline — a Spark-native cross-platform content analytics warehouse.

Raw landed tables are conformed into staging DataFrames, unified across
platforms, modelled as a star schema with reporting marts, maintained with
keyed upserts / insert-if-absent / time-range overwrites, and gated by
data-quality audits.  Every operator is a pure ``(DataFrame, ...) -> DataFrame``
function; only ``operators.maintain`` and ``streaming`` write.
"""

from castline.session import configure, get_session, scratch_path

__all__ = ["configure", "get_session", "scratch_path"]
