"""Token counts by byte-pair merging with a heap and a linked list.

A word starts as its bytes. The heap holds the ranks of adjacent pairs; the
lowest-ranked pair, leftmost first, is popped and merged, its neighbours in the
linked list get new pairs, and pairs that a merge has undone are skipped when
popped. The word's count is its bytes minus the merges: no token gets an
identifier. Words repeat, so a worker remembers the counts of recent pieces.

The vocabulary file (``tokenizers`` format) is read by the workers from its path;
special strings inside texts count as the library takes them by default: one
token each.

Defined cases: null and empty texts have 0 bytes and 0 tokens; every row gives
one row, repeated or not; null ids stay null; an empty table gives an empty
result; other columns are ignored. Texts of any length are counted whole, in
segments of bounded size.
"""

from __future__ import annotations

import heapq
import json

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .chunks import Recent, as_text, by_text
from .common import text_or_empty

SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
# The byte-level splitting rule, with white space spelled out.
SPLIT = regex.compile(rf"'(?:[sdmt]|ll|ve|re)| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")


def byte_symbols() -> dict[int, str]:
    """The letter that stands for each byte: printable ones for themselves, the others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class PairMerger:
    """Counts of words and texts under one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        merges = (m.split(" ") if isinstance(m, str) else m for m in file["model"]["merges"])
        self.ranks = {tuple(m): i for i, m in enumerate(merges)}
        self.symbols = byte_symbols()
        special = [t["content"] for t in file["added_tokens"]]
        if any(t[k] for t in file["added_tokens"] for k in ("single_word", "lstrip", "rstrip")) or any(regex.search(r"\s", s) for s in special):
            raise ValueError("only special strings without conditions and white space are known here")
        self.special = regex.compile("|".join(regex.escape(s) for s in sorted(special, key=len, reverse=True))) if special else None
        self.words = Recent(lambda ws: [self.count_word(w) for w in ws])

    def count_word(self, word: str) -> int:
        """Initial symbols minus merges."""
        symbols = list(word.encode("utf-8").decode("latin-1").translate(self.symbols))
        n, ranks = len(symbols), self.ranks
        if n == 1:
            return 1
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i) for i in range(n - 1) if (r := ranks.get((symbols[i], symbols[i + 1]))) is not None]
        heapq.heapify(heap)
        merges = 0
        while heap:
            rank, i = heapq.heappop(heap)
            j = after[i]
            if symbols[i] is None or j >= n or ranks.get((symbols[i], symbols[j])) != rank:
                continue  # undone by an earlier merge
            symbols[i] += symbols[j]
            symbols[j] = None
            merges += 1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (r := ranks.get((symbols[i], symbols[k]))) is not None:
                    heapq.heappush(heap, (r, i))
            h = before[i]
            if h >= 0 and (r := ranks.get((symbols[h], symbols[i]))) is not None:
                heapq.heappush(heap, (r, h))
        return n - merges

    def count_pieces(self, texts: list[str]) -> list[int]:
        split, out = [], []
        for t in texts:
            found = len(self.special.findall(t)) if self.special else 0
            parts = self.special.split(t) if found else [t]
            split.append((found, [w for p in parts for w in SPLIT.findall(p)]))
        counts = self.words.of({w for _, ws in split for w in ws})
        for found, ws in split:
            out.append(found + sum(map(counts.__getitem__, ws)))
        return out


_MERGERS: dict[str, tuple[PairMerger, Recent]] = {}


def merger(path: str) -> tuple[PairMerger, Recent]:
    """One for each worker process and vocabulary file."""
    if path not in _MERGERS:
        m = PairMerger(path)
        _MERGERS[path] = m, Recent(lambda ps: m.count_pieces([as_text(p) for p in ps]))
    return _MERGERS[path]


def count(documents: DataFrame, path: str, limit: int = 1024) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_tokens, over_limit (n_tokens > limit)."""
    d = documents.select("doc_id", text_or_empty().alias("text"), F.octet_length(text_or_empty()).cast("long").alias("n_bytes"))

    def counted(batches):
        recent = merger(path)[1]
        for batch in batches:
            texts = batch.column("text").to_pylist()
            n = [sum(parts) for parts in by_text(texts, recent, sum)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_bytes"), pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    kind = d.schema["doc_id"].dataType.simpleString()
    return d.mapInArrow(counted, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")
