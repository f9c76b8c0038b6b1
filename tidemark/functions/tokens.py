"""Column expressions on text and token arrays used in corpus preparation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The pattern that cuts text into pre-tokens, the document cap in characters, the character budget
# of vocabulary training, documents per batch, vocabulary size and special tokens.
SPLIT_PATTERN = (
    r"'(?i:[sdmt]|ll|ve|re)|[^\r\n\p{L}\p{N}]?+\p{L}+|\p{N}{1,2}| ?[^\s\p{L}\p{N}]++[\r\n]*|\s*[\r\n]|\s+(?!\S)|\s+"
)
DOC_CAP = 10_000
CHAR_BUDGET = 1_000_000_000
DOCS_PER_BATCH = 128
VOCAB_SIZE = 8_192
SPECIAL_TOKENS = ("<|reserved_0|>", "<|reserved_1|>", "<|reserved_2|>", "<|reserved_3|>")
BOS_TOKEN = SPECIAL_TOKENS[0]


def capped(text: Column, cap: int = DOC_CAP) -> Column:
    return F.substring(text, 1, cap)


def pretokens(text: Column) -> Column:
    """The text cut into pre-tokens; joined they give the text again.

    ``(?U)`` makes white space and letter classes follow Unicode.
    """
    return F.regexp_extract_all(text, F.lit("(?U)" + SPLIT_PATTERN), F.lit(0))


def inputs(tokens: Column) -> Column:
    """All tokens but the last."""
    return F.slice(tokens, F.lit(1), F.greatest(F.size(tokens) - 1, F.lit(0)))


def targets(tokens: Column) -> Column:
    """All tokens but the first."""
    return F.slice(tokens, F.lit(2), F.greatest(F.size(tokens) - 1, F.lit(0)))
