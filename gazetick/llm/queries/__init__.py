"""All registered queries of the subpackage."""

from gazetick.llm.queries import byte_bpe, chat, collocations, knn, langid, mask_search, mixing, nn_descent, piece_bpe, repeats, revisits, secrets, simhash  # noqa: F401
from gazetick.llm.queries.registry import QUERIES, SQL  # noqa: F401
