"""Token counts of sections by offset mapping.

A whole document is encoded once. Token byte lengths give the byte span of each
token, and those its character span: from the character that holds its first
byte to the one that holds its last. Sections are character intervals of the
same text. Both lists are sorted, so the interval join of a document is one
binary search per token in the task that holds it, and nothing is shuffled.

A token that crosses a boundary goes by an explicit rule:

- ``start``: to the section of its first character;
- ``end``: to the section of its last character;
- ``majority``: to the section with most of its characters, the first of equals.

Every token goes to exactly one section, so a document's sections add up to its tokens.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import map_batches, pieces

RULES = ("start", "end", "majority")
VOCABULARY = "byte_bpe_50k.tiktoken"
#: A section: a line with its end, and the empty lines after it.
_SECTION = re.compile(r"[^\n]*\n+|[^\n]+\Z")


def line_sections(text: str) -> np.ndarray:
    """Starts of the sections of ``text`` in characters; they leave no gap. Leading empty lines are a section of their own."""
    return np.array([m.start() for m in _SECTION.finditer(text)], dtype=np.int64)


class Encoder:
    """Token ids of whole texts and the byte length of each id."""

    def __init__(self, vocabulary: str = VOCABULARY):
        import public_tokenizers
        import tiktoken

        with open(vocabulary if "/" in vocabulary else public_tokenizers.path(vocabulary), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.length = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
        self.length[list(ranks.values())] = [len(b) for b in ranks]

    def spans(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """(first, last) character of each token of ``text``."""
        size = self.length[np.array(self.encoding.encode_ordinary(text), dtype=np.int64)]
        end = np.cumsum(size)
        begins = (np.frombuffer(text.encode("utf-8"), dtype=np.uint8) & 0xC0) != 0x80
        char = np.cumsum(begins) - 1  # of each byte
        return char[end - size], char[end - 1]


def attribute(first: np.ndarray, last: np.ndarray, starts: np.ndarray, rule: str = "start") -> np.ndarray:
    """Number of tokens in each section; ``starts`` are ascending and the first is at most the first token's character."""
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    a = np.searchsorted(starts, first, side="right") - 1
    if rule != "start":
        b = np.searchsorted(starts, last, side="right") - 1
        if rule == "end":
            a = b
        else:
            for k in np.flatnonzero(a != b).tolist():
                edges = np.concatenate([[first[k]], starts[a[k] + 1:b[k] + 1], [last[k] + 1]])
                a[k] += int(np.argmax(np.diff(edges)))
    return np.bincount(a, minlength=len(starts))


def section_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rule: str = "start", vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, section, first_char, n_chars, n_tokens): a row per line section of every text.

    Null and empty texts have one empty section without tokens; null ids and
    repeated rows are counted like any other; other columns play no part.
    """
    names = ["doc_id", "section", "first_char", "n_chars", "n_tokens"]

    def make():
        encoder = Encoder(vocabulary)

        def batch(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            for part in pieces(rows):
                starts, counts, sizes = [], [], []
                for text in part.column(1).to_pylist():
                    start = line_sections(text) if text else np.zeros(1, dtype=np.int64)
                    starts.append(start)
                    sizes.append(np.diff(np.append(start, len(text or ""))))
                    counts.append(attribute(*encoder.spans(text), start, rule) if text else np.zeros(1, dtype=np.int64))
                n = np.array([len(s) for s in starts])
                yield pa.RecordBatch.from_arrays([
                    part.column(0).take(pa.array(np.repeat(np.arange(len(n)), n))), pa.array(np.concatenate([np.arange(k) for k in n]).astype(np.int32)),
                    pa.array(np.concatenate(starts)), pa.array(np.concatenate(sizes)), pa.array(np.concatenate(counts).astype(np.int64))], names)
        return batch

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return map_batches(rows, make, "doc_id long, section int, first_char long, n_chars long, n_tokens long")
