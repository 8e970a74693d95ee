"""All registered queries."""

from gazetick.queries import bar_queries, cluster_queries, feature_queries, table_queries, text_queries  # noqa: F401
from gazetick.queries.registry import QUERIES, SQL  # noqa: F401
