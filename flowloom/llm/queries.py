"""Imports every operator module, so that each registers its query."""

from flowloom.llm import (  # noqa: F401
    decontaminate,
    exact_dedup,
    fill_middle,
    langid,
    mixing,
    pieces,
    pii,
    prefix_trie,
    quality,
    secrets,
    sharding,
    simhash,
    substring_dedup,
)
