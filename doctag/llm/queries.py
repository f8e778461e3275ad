"""All queries of this subpackage."""

from doctag.llm import (  # noqa: F401
    chat,
    embeddings,
    jaccard,
    languages,
    lines,
    mixing,
    negatives,
    packing,
    quality,
    secrets,
    suffixes,
    topk,
    trie,
)
from doctag.llm.registry import QUERIES

__all__ = ["QUERIES"]
