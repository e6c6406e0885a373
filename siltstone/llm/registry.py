"""All queries of this subpackage."""

from siltstone.llm import queries_corpus, queries_text, queries_web  # noqa: F401
from siltstone.llm.common import ORACLES, QUERIES  # noqa: F401
