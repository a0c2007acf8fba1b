"""BPE encoding and decoding by depth-first traversal of a trie of distinct words.

The merges give every prefix of a word exactly one valid last token: the token t
that ends there, is reachable by merges, and may stand after the last token of
the prefix before t. So one state per trie node, its last token, describes the
encoding of that prefix. The distinct words of a batch are inserted in sorted
order, which visits their trie depth-first: the states along the path that a
word shares with the one before it stand on a stack and are computed once.
Word ends are symbols of their own, so a word's last step uses the word-end
vocabulary.

Two tokens may stand side by side if no merge crosses their border while both
are built up: their right and left spines are walked in the order of the ranks.

Defined cases: null and empty texts have no tokens and decode to ""; strings of
added tokens become their ids, as the library does by default; texts with
characters whose classes could differ between libraries are normalised and split
by the tokenizer's own components and then encoded the same way; words that
repeat are encoded once; extra columns pass through (result columns win).
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator
from functools import cache
from struct import pack

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ._pieces import WORD_END, byte_alphabet, is_plain, special_splitter
from ._spark import map_texts
from ._text import text_batches

BATCH_BYTES = 1 << 20
#: Words whose ids a worker keeps, and token pairs that it keeps judged.
TABLE_ENTRIES, PAIR_ENTRIES = 160_000, 150_000
_NEVER = 1 << 60
_BITS = 20
_SHORT = (2, 1)


class TrieBpe:
    """Encoder and decoder for one tokenizers file with a word-end suffix."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["type"] != "BPE" or spec["decoder"] is not None or spec["post_processor"] is not None:
            raise ValueError("a BPE file without decoder and post-processor is expected")
        end = model["end_of_word_suffix"] or ""
        vocab: dict[str, int] = model["vocab"]
        added = spec["added_tokens"]
        size = max([*vocab.values(), *(t["id"] for t in added)]) + 1
        if size >> _BITS:
            raise ValueError("a vocabulary of less than a million tokens is expected")
        self.alphabet = dict(enumerate(byte_alphabet()))
        #: Rank of each mergeable pair, by both ids in one number; for each token the rank that makes it and its two parts.
        self.merges: dict[int, int] = {}
        self.rank, self.left, self.right = [-1] * size, [-1] * size, [-1] * size
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            whole, left, right = vocab[a + b], vocab[a], vocab[b]
            self.merges.setdefault(left << _BITS | right, rank)
            if self.rank[whole] < 0:
                self.rank[whole], self.left[whole], self.right[whole] = rank, left, right
        self.pairs: dict[int, bool] = {}
        own = {t["content"] for t in added}
        reach: dict[int, bool] = {}
        #: Tokens by their symbols: inner ones and word-final ones.
        usable = {s: i for s, i in vocab.items() if s not in own and self._reachable(i, reach)}
        self.inner = {s: i for s, i in usable.items() if not (end and s.endswith(end))}
        self.final = {s[: -len(end)]: i for s, i in usable.items() if s.endswith(end)} if end else self.inner
        self.lengths = self._lengths(self.inner), self._lengths(self.final)
        self.sizes = [0] * size
        for part in (self.inner, self.final):
            for s, i in part.items():
                self.sizes[i] = len(s)
        self.special = special_splitter(sorted(own))
        self.added = {t["content"]: t["id"].to_bytes(4, "little") for t in added}
        #: Ids by word: those met since the last turn, and those of the turn before.
        self.table: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.names = np.empty(size, dtype=object)
        for s, i in vocab.items():
            self.names[i] = s
        for t in added:
            self.names[t["id"]] = t["content"]
        self.plain = model["dropout"] is None and not model["ignore_merges"] and self._known(spec)

    @staticmethod
    def _known(spec: dict) -> bool:
        """Whether the fast splitter equals this file's normaliser and pattern."""
        return '"Removed"' in (s := json.dumps(spec["pre_tokenizer"])) and r"[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+" in s and "Lowercase" in json.dumps(spec["normalizer"]) and "NFC" in json.dumps(spec["normalizer"])

    @staticmethod
    def _lengths(tokens: dict[str, int]) -> dict[str, tuple[int, ...]]:
        """The lengths of the tokens that end in the same three symbols, from the longest down; 2 and 1 come behind all."""
        found: dict[str, set[int]] = {}
        for s in tokens:
            if len(s) > 2:
                found.setdefault(s[-3:], {2, 1}).add(len(s))
        kept: dict[tuple, tuple] = {}
        return {end: kept.setdefault(own, own) for end, sizes in found.items() if (own := tuple(sorted(sizes, reverse=True)))}

    def spine(self, token: int, side: list[int]) -> tuple[list[int], list[int]]:
        """The tokens at one edge of a token while it is built, and the rank at which each is merged away."""
        chain, leaves = [token], [_NEVER]
        while self.rank[chain[-1]] >= 0:
            leaves.append(self.rank[chain[-1]])
            chain.append(side[chain[-1]])
        return chain[::-1], leaves[::-1]

    def quiet(self, a: int, b: int) -> bool:
        """No merge crosses the border of a and b before both are whole."""
        xs, nx = self.spine(a, self.right)
        ys, ny = self.spine(b, self.left)
        i = j = 0
        while i < len(xs) - 1 or j < len(ys) - 1:
            rank = self.merges.get(xs[i] << _BITS | ys[j], _NEVER)
            if rank < nx[i] and rank <= ny[j]:
                return False
            if nx[i] <= ny[j]:
                i += 1
            else:
                j += 1
        return True

    def _reachable(self, token: int, known: dict[int, bool]) -> bool:
        if self.rank[token] < 0:
            return True
        got = known.get(token)
        if got is None:
            a, b = self.left[token], self.right[token]
            got = known[token] = self._reachable(a, known) and self._reachable(b, known) and self.quiet(a, b)
        return got

    def follows(self, a: int, b: int) -> bool:
        return a << _BITS | b not in self.merges and self.quiet(a, b)

    def encode_words(self, words: list[str]) -> Iterator[tuple[str, list[int]]]:
        """(word, ids) of distinct words of alphabet symbols, by depth-first traversal of their trie.

        A node's last token is the one token that ends there, from the longest down, and may follow the last token of the
        node where it starts.
        """
        states, path = [-1], ""
        pairs, sizes = self.pairs, self.sizes
        if len(pairs) > PAIR_ENTRIES:
            pairs.clear()
        inner, final = self.inner.get, self.final.get
        for word in sorted(words):
            shared, size = 0, len(word)
            most = min(len(path), size - 1, len(states) - 1)
            while shared < most and path[shared] == word[shared]:
                shared += 1
            del states[shared + 1 :]
            find, lengths = inner, self.lengths[0]
            for to in range(shared + 1, size + 1):
                if to == size:
                    find, lengths = final, self.lengths[1]
                for length in lengths.get(word[to - 3 : to], _SHORT) if to > 2 else _SHORT:
                    start = to - length
                    token = find(word[start:to]) if start >= 0 else None
                    if token is not None:
                        if not start:
                            break
                        key = states[start] << _BITS | token
                        ok = pairs.get(key)
                        if ok is None:
                            ok = pairs[key] = self.follows(states[start], token)
                        if ok:
                            break
                else:
                    raise ValueError(f"no token ends {word[:to]!r}")
                states.append(token)
            path, at, ids = word, size, []
            token = states.pop()
            while True:
                ids.append(token)
                at -= sizes[token]
                if not at:
                    break
                token = states[at]
            ids.reverse()
            yield word, ids

    def split(self, part: str) -> list[str]:
        if self.plain and is_plain(part):
            return WORD_END.findall(part.lower())
        if self.library.normalizer:
            part = self.library.normalizer.normalize_str(part)
        # Words of the library's splitter are spelled in alphabet symbols; a mark tells them from raw ones.
        return ["\0" + x for x, _ in self.library.pre_tokenizer.pre_tokenize_str(part)] if part else []

    def learn(self, words: set[str]) -> None:
        """Bring the ids of all words into the table; only those are encoded that it has not met in this turn or the last."""
        if len(self.table) > TABLE_ENTRIES // 2:
            self.table, self.older = {}, self.table
        self.table.update(self.added)
        new = words.difference(self.table)
        known = new & self.older.keys()
        self.table.update(zip(known, map(self.older.__getitem__, known), strict=True))
        spelled: dict[str, list[str]] = {}
        for w in new - known:
            spelled.setdefault(w if w.isascii() and w.isprintable() else w[1:] if w[0] == "\0" else w.encode().decode("latin-1").translate(self.alphabet), []).append(w)
        for symbols, ids in self.encode_words(list(spelled)):
            value = pack(f"<{len(ids)}I", *ids)
            for w in spelled[symbols]:
                self.table[w] = value

    def encode(self, texts: list[str]) -> Iterator[tuple[bytes, str]]:
        """The ids of each text as little-endian bytes, and its decoded text."""
        split = [
            [w for part in (self.special.split(t) if self.special and self.special.search(t) else [t]) for w in ([part] if part in self.added else self.split(part))] for t in texts
        ]
        self.learn(set().union(*split))
        for words in split:
            ids = b"".join(map(self.table.__getitem__, words))
            yield ids, " ".join(self.names[np.frombuffer(ids, "<u4")].tolist())


@cache
def encoder(path: str) -> TrieBpe:
    return TrieBpe(path)


def encode_documents(docs: DataFrame, tokenizer_path: str, text_col: str = "text", outputs: str = "ids", batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """Each row encoded and decoded: n_tokens with ids and decoded ("ids"), or their SHA-256 digests ("digests").

    "text" replaces the text by the decoded one and keeps the other columns.
    """
    ddl = {"ids": "n_tokens long, ids array<int>, decoded string", "digests": "n_tokens long, ids_sha256 string, decoded_sha256 string"}[outputs]

    def run(batches: Iterator[pa.RecordBatch]):
        own = encoder(tokenizer_path)
        for batch in text_batches(batches, text_col, batch_bytes):
            got = list(own.encode(batch.column(text_col).fill_null("").to_pylist()))
            n = pa.array([len(ids) // 4 for ids, _ in got], pa.int64())
            if outputs == "digests":
                yield batch, [n, pa.array([hashlib.sha256(ids).hexdigest() for ids, _ in got]), pa.array([hashlib.sha256(text.encode()).hexdigest() for _, text in got])]
            else:
                yield batch, [n, pa.array([np.frombuffer(ids, "<i4") for ids, _ in got], pa.list_(pa.int32())), pa.array([text for _, text in got])]

    return map_texts(docs, text_col, run, ddl)


def decode_ids(rows: DataFrame, tokenizer_path: str, ids_col: str = "ids") -> DataFrame:
    """Each row with `decoded`, the library's decode(ids, skip_special_tokens=False); null ids: ""."""

    def run(batches: Iterator[pa.RecordBatch]):
        own = encoder(tokenizer_path)
        names = own.names
        for batch in batches:
            yield batch, [pa.array([" ".join(names[i] for i in ids or () if i is not None and 0 <= i < len(names) and names[i] is not None) for ids in batch.column(ids_col).to_pylist()], pa.string())]

    return map_texts(rows, ids_col, run, "decoded string", keep_text=True)
