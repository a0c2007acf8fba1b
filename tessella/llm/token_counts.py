"""Token counts: batch encoding in Arrow functions that return lengths only.

Record batches are joined and cut again so that each holds about the same number of bytes,
and long texts are split at safe boundaries: before a space between two
non-space characters, where the tokenizer's pre-splitting also cuts, so the
lengths of the parts add up to the length of the whole. Only the distinct
pre-split pieces that a worker has not met yet are encoded, as one batch; their
lengths are kept in a bounded table. Where a file's ids follow its merges, as in
the published byte-level vocabularies, the batch goes through a rank encoder
built from the same file, which is several times faster on short pieces and
gives the same ids; otherwise through the tokenizers library itself.

Defined cases: null and empty texts have 0 tokens and 0 bytes; strings of added
tokens inside a text count as the library counts them (one token each); rows
are never dropped; extra columns pass through unless they clash with a result
column, in which case the result column wins.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._pieces import BYTE_LEVEL, byte_alphabet, is_plain, special_splitter
from ._spark import map_texts
from ._text import balanced_batches

_SAFE = re.compile(r"(?<=\w) (?=\w)")
BATCH_BYTES = 2 << 20
PART_CHARS = 1 << 16
TABLE_ENTRIES = 400_000


def safe_parts(text: str, limit: int = PART_CHARS) -> Iterator[str]:
    """Parts of about `limit` characters; a text without a safe boundary stays whole."""
    start = 0
    while len(text) - start > limit:
        cut = _SAFE.search(text, start + limit)
        if not cut:
            break
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:]


class Counter:
    """Token counts of texts by one tokenizers file."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        plain = (spec["pre_tokenizer"] or {}).get("type") == "ByteLevel" and spec["pre_tokenizer"].get("use_regex") and not spec["pre_tokenizer"]["add_prefix_space"]
        added = spec["added_tokens"]
        #: Without these properties every text goes whole through the library.
        self.split = plain and spec["normalizer"] is None and not any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in added)
        self.special = special_splitter([t["content"] for t in added])
        self.marks = {t["content"] for t in added}
        self.sizes: dict[str, int] = {}
        self.ranked = self.split and self._ranked(spec["model"])

    def _ranked(self, model: dict):
        """A rank encoder for pieces if ids rise with the merges and all bytes are tokens, else None."""
        import tiktoken

        own = {c: b for b, c in enumerate(byte_alphabet())}
        vocab = {s: i for s, i in model["vocab"].items() if s not in self.marks}
        order = [vocab["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
        single = [vocab[c] for c in own if c in vocab]
        if model["type"] != "BPE" or model["dropout"] or model["ignore_merges"] or model["end_of_word_suffix"] or len(single) < 256 or len(single) + len(order) != len(vocab) or order != sorted(set(order)) or max(single) > order[0]:
            return None
        ranks = {bytes(own[c] for c in s): i for s, i in vocab.items()}
        self.gap = ranks[b"\0"]
        # The pieces are cut already; the pattern takes each whole, up to the zero that ends it.
        return tiktoken.Encoding("pieces", pat_str=r"[^\x00]+|\x00", mergeable_ranks=ranks, special_tokens={}).encode_to_numpy

    def batch(self, pieces: list[str]) -> list[int]:
        """The lengths of pieces without zeros, encoded in one call each about a million characters."""
        if not self.ranked:
            return self.whole(pieces)
        out: list[int] = []
        ends = np.cumsum([len(x) + 1 for x in pieces])
        start = 0
        while start < len(pieces):
            stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + (1 << 20))))
            gaps = np.flatnonzero(self.ranked("\0".join([*pieces[start:stop], ""])) == self.gap)
            out += (np.diff(gaps, prepend=-1) - 1).tolist()
            start = stop
        return out

    def whole(self, texts: list[str]) -> list[int]:
        return [len(e.ids) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def counts(self, texts: list[str]) -> list[int]:
        if not self.split:
            return self.whole(texts)
        out = [0] * len(texts)
        odd: list[int] = []
        pieces: list[list[str]] = []
        for k, text in enumerate(texts):
            mine: list[str] = []
            if not is_plain(text):
                odd.append(k)
            else:
                parts = self.special.split(text) if self.special and self.special.search(text) else [text]
                for part in parts:
                    if part in self.marks:
                        out[k] += 1
                    elif len(part) > PART_CHARS:
                        for x in safe_parts(part):
                            mine += BYTE_LEVEL.findall(x)
                    else:
                        mine += BYTE_LEVEL.findall(part)
            pieces.append(mine)
        if len(self.sizes) > TABLE_ENTRIES:
            self.sizes.clear()
        if new := list(set().union(*pieces).difference(self.sizes)):
            self.sizes.update(zip(new, self.batch(new), strict=True))
        size = self.sizes.__getitem__
        for k, mine in enumerate(pieces):
            out[k] += sum(map(size, mine))
        if odd:
            parts = [list(safe_parts(texts[k])) for k in odd]
            lengths = iter(self.whole([x for own in parts for x in own]))
            for k, own in zip(odd, parts, strict=True):
                out[k] = sum(next(lengths) for _ in own)
        return out


@cache
def counter(path: str) -> Counter:
    return Counter(path)


def count_tokens(docs: DataFrame, tokenizer_path: str, limit: int = 512, text_col: str = "text", batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """Each row with n_bytes, n_tokens and over_limit (n_tokens > limit) in place of its text."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.Array]]:
        own = counter(tokenizer_path)
        for batch in balanced_batches(batches, text_col, batch_bytes):
            texts = batch.column(text_col).fill_null("")
            yield batch, [pc.binary_length(texts.cast(pa.large_binary())).cast(pa.int64()), pa.array(own.counts(texts.to_pylist()), pa.int64())]

    return map_texts(docs, text_col, count, "n_bytes long, n_tokens long").withColumn("over_limit", F.col("n_tokens") > limit)
