"""laborlake: a Spark-native medallion pipeline for content-production and labor data.

Sources land raw content events, labor-log pages and CSV files; the silver
layer validates, cleans, de-duplicates and flags them; the gold layer and the
warehouse reports summarise silver. Every operator is a DataFrame/SQL plan so
Catalyst and AQE choose the physical strategy.
"""

from laborlake.session import build_session, scratch_root

__all__ = ["build_session", "scratch_root"]
