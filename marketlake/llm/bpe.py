"""Operator 1: byte-level BPE encoding by prefix-sharing trie traversal, and decoding.

The words of a batch that are not yet known go into a trie, which is walked depth-first. At a
node, the last token of the prefix spelled so far follows from shorter prefixes alone: it is
the one token ending here that can stand after the last token of the prefix before it, that
is, the pair of both encodes to itself. So a node needs one look at each token that ends
there, a prefix shared by many words is done once, and a word's encoding is read off
backwards from its last node. The result equals merging by rank.

Map-only: each task encodes its own rows, batch by batch. The trie lives for one batch; a
worker remembers a bounded number of encoded chunks. Words too long to share prefixes go
through the same recurrence in flat arrays. Nulls encode as empty, empty texts have no ids,
equal rows give equal ids, other columns pass through; the output column replaces a column
of its name.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.llm import byte_bpe
from marketlake.session import small_batches

#: Words of more bytes share no prefixes in practice and stay out of the trie and the memory.
LONG_WORD = 256


class Encoder:
    """Encodes words with one vocabulary; remembers which pairs can stand side by side."""

    MAX_PAIRS = 300_000

    def __init__(self, vocab: byte_bpe.Vocabulary):
        self.vocab = vocab
        # token -> {token before it: whether it can follow}; dropped as a whole when full
        self._pairs: dict[bytes, dict[bytes, bool]] = {}
        self._n_pairs = 0
        # what a token can begin with -> None (no token, or one that never ends a prefix), True (a token not
        # looked at yet) or its entry of _pairs
        self._starts: dict[bytes, dict[bytes, bool] | bool | None] = {t[:n]: None for t in vocab.ids for n in range(1, len(t))}
        self._starts.update(dict.fromkeys(vocab.ids, True))
        self._one = {token: token for token in vocab.ids}  # pairs share these instead of holding slices of words
        self._packed = {token: array("i", [i]).tobytes() for token, i in vocab.ids.items()}
        self._made = {a + b: (a, b, rank) for (a, b), rank in vocab.merges.items()}
        made, never = self._made, ("", "", -1)
        # as training leaves it: one merge makes a token, later than its parts were made
        self._regular = len(made) == len(vocab.merges) and all(
            rank > made.get(a, never)[2] and rank > made.get(b, never)[2] for a, b, rank in made.values())
        self._edges: dict[bytes, tuple[list, list]] = {}
        self._usable: dict[bytes, bool] = {}

    def _merged(self, data: bytes) -> list[bytes]:
        """Plain merging by rank, leftmost first, of a token's or a pair's few bytes."""
        parts = [data[i:i + 1] for i in range(len(data))]
        ranks = self.vocab.merges
        while len(parts) > 1:
            rank, i = min((ranks.get((a, b), len(ranks)), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)))
            if rank == len(ranks):
                break
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def _is_usable(self, token: bytes) -> bool:
        """Whether merging rebuilds the token from its bytes; else it never ends a prefix."""
        known = self._usable[token] = self._merged(token) == [token]
        return known

    def _edge(self, token: bytes) -> tuple[list, list]:
        """The symbols that stand at the token's left and right end while it is made, each
        with the rank of the merge that takes it up (the token itself: none)."""
        ends = []
        for side in (0, 1):
            symbol, until, end = token, len(self.vocab.merges), []
            while True:
                end.append((symbol, until))
                if symbol not in self._made:
                    break
                until = self._made[symbol][2]
                symbol = self._made[symbol][side]
            ends.append(end)
        known = self._edges[token] = (ends[0], ends[1])
        return known

    def _stands(self, left: bytes, right: bytes) -> bool:
        """Whether ``right`` can follow ``left``, that is, both together encode to just these
        two: no merge across the border comes before the merges that take its symbols up."""
        if self._regular:
            merges = self.vocab.merges
            ends = (self._edges.get(left) or self._edge(left))[1]
            starts = (self._edges.get(right) or self._edge(right))[0]
            known = not any((rank := merges.get((x, y))) is not None and rank < x_until and rank <= y_until
                            for x, x_until in ends for y, y_until in starts)
        else:
            known = self._merged(left + right) == [left, right]
        return known

    def _followers(self, token: bytes) -> dict[bytes, bool] | None:
        """The token's entry of ``_pairs``, None if it is not usable."""
        if len(self._pairs) >= self.MAX_PAIRS:
            self._forget()
        usable = self._usable.get(token)
        if usable is None:
            usable = self._is_usable(token)
        known = self._starts[token] = self._pairs.setdefault(token, {}) if usable else None
        return known

    def _forget(self) -> None:
        self._starts.update(dict.fromkeys(self._pairs, True))
        self._pairs.clear()
        self._n_pairs = 0

    def _learn_pair(self, left: bytes, right: bytes) -> bool:
        if self._n_pairs >= self.MAX_PAIRS:
            self._forget()
        known = self._stands(left, right)
        self._n_pairs += 1
        self._followers(right)[self._one.get(left, left)] = known
        return known

    def _walk(self, word: bytes, lows: list[int], last: list[bytes]) -> None:
        """From the states of a prefix to those of ``word``: ``last[d]`` is the last token of ``word[:d]``, ``lows[d]`` the
        first place from which on ``word[:d]`` ends with what a token can begin with. It only grows with d, so no
        token that ends further on starts before it."""
        find = self._starts.get
        for depth in range(len(last), len(word) + 1):
            start, low = lows[-1], -1
            while start < depth:
                token = word[start:depth]
                known = find(token, False)
                if known is not False:
                    if low < 0:
                        low = start
                    if known is True:
                        known = self._followers(token)
                    if known is not None:
                        if not start:
                            break
                        before = last[start]
                        stands = known.get(before)
                        if stands is None:
                            stands = self._learn_pair(before, token)
                        if stands:
                            break
                start += 1
            else:
                raise ValueError("the vocabulary lacks a byte")
            lows.append(low)
            last.append(token)

    def _read_off(self, last: list[bytes], depth: int) -> bytes:
        out, packed = [], self._packed
        while depth:
            token = last[depth]
            out.append(packed[token])
            depth -= len(token)
        out.reverse()
        return b"".join(out)

    def encode_long(self, word: bytes) -> bytes:
        """One word alone, by the recurrence over its prefixes."""
        lows, last = [0], [b""]
        self._walk(word, lows, last)
        return self._read_off(last, len(word))

    def encode_words(self, words: Iterable[str]) -> dict[str, bytes]:
        """Distinct words to ids as int32 bytes, by a depth-first walk over their trie. Sorted words (UTF-8 sorts as
        its characters do) are the trie's leaves in depth-first order: the walk goes back to the prefix shared with the word
        before and on from there, and ``lows`` and ``last`` hold the states of the nodes on its path."""
        out: dict[str, bytes] = {}
        lows, last = [0], [b""]
        path = b""
        for text in sorted(words):
            word = text.encode()
            if len(word) > LONG_WORD:
                out[text] = self.encode_long(word)
                continue
            shared, most = 0, min(len(word), len(path))
            while shared < most and word[shared] == path[shared]:
                shared += 1
            del lows[shared + 1:], last[shared + 1:]
            self._walk(word, lows, last)
            path = word
            out[text] = self._read_off(last, len(word))
        return out


class _Memory(dict):
    """chunk (or word of one) -> its ids as int32 bytes, filled batch by batch and bounded."""

    MOST = 100_000

    def __init__(self, vocab: byte_bpe.Vocabulary):
        super().__init__()
        self.encoder = Encoder(vocab)
        self.again: set[str] = set()

    def trim(self, wanted: set[str]) -> None:
        """When full, forget the chunks that were not wanted again since the last time (or, where those are
        many, that are not wanted now). Ids take more room than counts, so fewer are remembered."""
        most = min(self.MOST, byte_bpe.MAX_REMEMBERED // 4)
        if len(self) > most:
            keep = self.again if len(self.again) <= most // 2 else wanted
            kept = {c: self[c] for c in keep if c in self}
            self.clear()
            self.update(kept)
            self.again = set()

    def learn(self, unknown: set[str]) -> dict[str, bytes]:
        """Encode chunks; returns those that are too long to be remembered."""
        split, new = [], set()
        for chunk in unknown:
            ws = byte_bpe.words(chunk)
            new.update(ws)
            if len(ws) > 1:
                split.append((chunk, ws))
        new = new.difference(self)
        self.update(self.encoder.encode_words(new))
        self.update({chunk: b"".join([self[w] for w in ws]) for chunk, ws in split})
        return {c: self.pop(c) for c in {*new, *unknown} if len(c) > LONG_WORD}


@cache
def _memory(vocabulary: str) -> _Memory:
    return _Memory(byte_bpe.load_vocabulary(vocabulary))


def _ids(texts: list[str | None], memory: _Memory, vocab: byte_bpe.Vocabulary) -> list[bytes]:
    """The ids of each text as int32 bytes."""
    split = [list(byte_bpe.pieces(t, vocab)) if t else [] for t in texts]
    wanted = set().union(*(cs for parts in split for special, cs in parts if not special))
    memory.trim(wanted)
    unknown = wanted.difference(memory)
    memory.again |= wanted - unknown
    once = memory.learn(unknown)
    specials = {s: array("i", [i]).tobytes() for s, i in vocab.specials.items()}
    find = memory.__getitem__
    out = []
    for parts in split:
        found = []
        for special, cs in parts:
            if special:
                found.append(specials[cs[0]])
            elif once:
                found.extend([once[c] if c in once else memory[c] for c in cs])
            else:
                found.extend(map(find, cs))
        out.append(b"".join(found))
    return out


def _groups(texts: pa.Array, size: int = 1_000_000) -> Iterator[list[str | None]]:
    """Consecutive texts of about ``size`` characters: bounds the memory beside one text."""
    group, chars = [], 0
    for x in texts:
        text = x.as_py()
        group.append(text)
        chars += len(text or "")
        if chars >= size:
            yield group
            group, chars = [], 0
    if group:
        yield group


def _encoded(batches: Iterator[pa.RecordBatch], vocabulary: str, text_col: str, ids_col: str) -> Iterator[pa.RecordBatch]:
    pa.default_memory_pool().release_unused()  # what other operators left behind in this worker
    vocab, memory = byte_bpe.load_vocabulary(vocabulary), _memory(vocabulary)
    for batch in batches:
        kept = [c for c in batch.schema.names if c != ids_col]
        row = 0
        for group in _groups(batch.column(text_col)):
            ids = _ids(group, memory, vocab)
            offsets = np.concatenate([[0], np.cumsum([len(x) // 4 for x in ids])]).astype(np.int32)
            part = batch.slice(row, len(group))
            row += len(group)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(ids), np.int32)))
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), lists], names=[*kept, ids_col])


@cache
def _tokens(vocabulary: str) -> list[bytes]:
    """Token bytes by id; the last one, empty, stands for ids out of the vocabulary."""
    by_id = byte_bpe.load_vocabulary(vocabulary).by_id
    return [by_id.get(i, b"") for i in range(max(by_id) + 1)] + [b""]


def _decoded(batches: Iterator[pa.RecordBatch], vocabulary: str, ids_col: str, text_col: str) -> Iterator[pa.RecordBatch]:
    table = _tokens(vocabulary)
    for batch in batches:
        kept = [c for c in batch.schema.names if c != text_col]
        lists, texts = batch.column(ids_col), []
        for i in range(len(lists)):
            values = lists[i].values
            ids = np.empty(0, np.int64) if values is None else values.to_numpy(zero_copy_only=False)
            ids = np.where((ids >= 0) & (ids < len(table)), ids, -1).tolist()
            texts.append(b"".join([table[j] for j in ids]).decode("utf-8", "replace"))
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(texts, pa.string())], names=[*kept, text_col])


def _ids_field(name: str) -> T.StructField:
    return T.StructField(name, T.ArrayType(T.IntegerType(), False), False)


def encode(df: DataFrame, vocabulary: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """Add ``ids_col``, the token ids (array of int) of ``text_col``, as the tokenizers
    library gives them with ``add_special_tokens=False`` and no truncation or padding.

    ``vocabulary`` is the path of a byte-level BPE ``.json`` that every executor can read."""
    small_batches(df.sparkSession)
    kept = [c for c in df.columns if c != ids_col]
    schema = T.StructType([*(df.schema[c] for c in kept), _ids_field(ids_col)])
    return df.select([F.col(f"`{c}`") for c in kept]).mapInArrow(lambda it: _encoded(it, vocabulary, text_col, ids_col), schema)


def decode(df: DataFrame, vocabulary: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """Add ``text_col``, the text of the ids (special tokens included), as the tokenizers
    library decodes them: bytes that are no UTF-8 become U+FFFD, ids out of the vocabulary
    and null lists give nothing."""
    small_batches(df.sparkSession)
    kept = [c for c in df.columns if c != text_col]
    schema = T.StructType([*(df.schema[c] for c in kept), T.StructField(text_col, T.StringType(), False)])
    return df.select([F.col(f"`{c}`") for c in kept]).mapInArrow(lambda it: _decoded(it, vocabulary, ids_col, text_col), schema)


def encode_and_decode(df: DataFrame, vocabulary: str, text_col: str = "text", ids_col: str = "ids", decoded_col: str = "decoded") -> DataFrame:
    """:func:`encode`, then :func:`decode`, in one Python worker per task instead of two."""
    small_batches(df.sparkSession)
    kept = [c for c in df.columns if c not in (ids_col, decoded_col)]
    schema = T.StructType([*(df.schema[c] for c in kept), _ids_field(ids_col), T.StructField(decoded_col, T.StringType(), False)])
    return df.select([F.col(f"`{c}`") for c in kept]).mapInArrow(
        lambda it: _decoded(_encoded(it, vocabulary, text_col, ids_col), vocabulary, ids_col, decoded_col), schema)
