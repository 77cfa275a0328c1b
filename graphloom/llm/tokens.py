"""Byte-level BPE ids by the tokenizers library, with a bounded memo of word pieces.

The pre-tokenizer of the byte-level vocabularies always cuts before a space that a
non-space follows, around a single line feed between non-spaces, and between a letter
or digit and a mark.  A text whose white space is only of those two kinds is therefore
the concatenation of its space-led pieces, and each distinct piece is encoded once per
worker.  Any other text goes to the library whole, as does every text of a vocabulary
with another pre-tokenizer.  Both ways give ``encode(text)``.

The string of an added token (an end marker, say) within a text gives that token's id,
as is the library's default, unless ``markers_as_text``.
"""

from __future__ import annotations

import gc
import json
import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from graphloom.llm.common import within

DEFAULT_VOCABULARY = "byte_bpe_50k.json"
#: Marks the piece that begins a text: no space leads it.  A text that holds it is irregular.
FIRST = "\x1e"
_MARKED = re.compile(r"([\n\x1e]?[^\W_]+)([^\w\s]+)\Z").match
#: White space that the piecewise way does not cover: doubled, at an end, or not space or line feed.
_IRREGULAR = (
    r"\A[ \n]|[ \n]\z|[ \n][ \n]|[\t\x0b-\r\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
_ENCODERS: dict[tuple, "Encoder"] = {}
#: Ids that are put in place at a time.
GATHER = 1 << 18
#: Letters that are given to the library at a time, or one text.
LETTERS = 1 << 16
#: Bytes of texts that are cut to pieces at a time, or one text.
SLICE = 8 << 20


def vocabulary_path(name: str) -> str:
    """A file path as given; a bare name is looked up among the public vocabularies."""
    if os.sep in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def encoder(vocabulary: str = DEFAULT_VOCABULARY, dtype: str = "<u4", markers_as_text: bool = False) -> "Encoder":
    """This worker's encoder; its memo serves one task after another."""
    key = (vocabulary, dtype, markers_as_text)
    if key not in _ENCODERS:
        _ENCODERS.clear()  # one memo a worker
        _ENCODERS[key] = Encoder(*key)
    return _ENCODERS[key]


class Memo:
    """Pieces and their ids in flat arrays, so that ``most`` bounds the bytes that are really held between batches.

    The table that finds pieces is built anew for each batch: it takes a small part of
    the batch's time, and nothing when no batch is worked on.
    """

    def __init__(self, dtype: np.dtype, most: int):
        self.most, self.batch = most, 0
        self.pieces, self.ids = pa.array([], pa.string()), np.empty(0, dtype)
        self.sizes, self.used = np.empty(0, np.int32), np.empty(0, np.int32)

    def held(self) -> int:
        return self.pieces.nbytes + self.ids.nbytes + self.sizes.nbytes + self.used.nbytes

    def find(self, pieces: pa.Array) -> np.ndarray:
        """The place of each piece, -1 where it is not remembered."""
        return pc.fill_null(pc.index_in(pieces, value_set=self.pieces), -1).to_numpy().copy()

    def add(self, pieces: list[str], bodies: list[bytes]) -> None:
        self.pieces = pa.concat_arrays([self.pieces, pa.array(pieces, pa.string())])
        self.ids = np.concatenate([self.ids, np.frombuffer(b"".join(bodies), self.ids.dtype)])
        self.sizes = np.concatenate([self.sizes, np.fromiter(map(len, bodies), np.int32, len(bodies)) // self.ids.itemsize], dtype=np.int32)
        self.used = np.concatenate([self.used, np.full(len(bodies), self.batch, np.int32)])

    def next_batch(self) -> None:
        """Beyond the bound, forget all but half of it, what was used last."""
        self.batch += 1
        if self.held() <= self.most:
            return
        size = pc.binary_length(self.pieces).to_numpy().astype(np.int64) + self.sizes.astype(np.int64) * self.ids.itemsize + 12
        latest = np.argsort(-self.used, kind="stable")
        kept = np.zeros(len(size), bool)
        kept[latest[np.cumsum(size[latest]) <= self.most // 2]] = True
        self.ids = self.ids[np.repeat(kept, self.sizes)]
        self.pieces, self.sizes, self.used = self.pieces.filter(pa.array(kept)), self.sizes[kept], self.used[kept]


class Encoder:
    """Encodes texts to little-endian id bytes of the given width (2 or 4).

    ``memo_bytes`` bounds the remembered pieces and their ids; a batch may go beyond it
    while it is worked on.
    """

    def __init__(self, vocabulary: str = DEFAULT_VOCABULARY, dtype: str = "<u4", markers_as_text: bool = False, memo_bytes: int = 24 << 20):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        # Many small strings that are kept: collecting garbage as often as usual finds none.
        gc.set_threshold(200_000, 20, 100)
        path = vocabulary_path(vocabulary)
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = markers_as_text
        with open(path, encoding="utf-8") as source:
            described = json.load(source)
        before = described.get("pre_tokenizer") or {}
        self.by_pieces = before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space") and not described.get("normalizer")
        added = [re.escape(x["content"]) for x in described.get("added_tokens", [])]
        self.whole = "|".join([_IRREGULAR, *added])
        self.dtype = np.dtype(dtype)
        if self.dtype.itemsize == 2 and self.tokenizer.get_vocab_size() > 65_536:
            raise ValueError("this vocabulary needs four-byte ids")
        self.memo = Memo(self.dtype, memo_bytes)

    def direct(self, texts: list[str]) -> list[bytes]:
        out: list[bytes] = []
        first, size = 0, 0
        for k, text in enumerate(texts):  # the library's results are large: a bounded number of letters at a time
            size += len(text) + 8
            if size > LETTERS or k + 1 == len(texts):
                got = self.tokenizer.encode_batch_fast(texts[first : k + 1], add_special_tokens=False)
                out += [np.array(x.ids, self.dtype).tobytes() for x in got]
                first, size = k + 1, 0
        return out

    def _learn(self, pieces: pa.Array) -> np.ndarray:
        """The places of distinct pieces in the memo, which then holds them all."""
        memo = self.memo
        memo.next_batch()
        at = memo.find(pieces)
        unknown = at < 0
        fresh = pieces.filter(pa.array(unknown)).to_pylist()
        marked = {w: (m[1], m[2]) for w in fresh if (m := _MARKED(w))}
        bodies: dict[str, bytes] = {w: b"" for w in fresh if w not in marked}
        cores = list({core for core, _ in marked.values() if core not in bodies})
        found = memo.find(pa.array(cores, pa.string()))
        ends = np.cumsum(memo.sizes, dtype=np.int64)
        known = {core: memo.ids[ends[k] - memo.sizes[k] : ends[k]].tobytes() for core, k in zip(cores, found.tolist()) if k >= 0}
        bodies.update((core, b"") for core in cores if core not in known)
        first = [w[1:] if w[:1] == FIRST else w if w[:1] == "\n" else " " + w for w in bodies]
        bodies.update(zip(list(bodies), self.direct(first)))
        tails = list({tail for _, tail in marked.values()})
        tail_ids = dict(zip(tails, self.direct(tails)))
        bodies |= {w: (known[core] if core in known else bodies[core]) + tail_ids[tail] for w, (core, tail) in marked.items()}
        place = dict(zip(bodies, range(len(memo.sizes), len(memo.sizes) + len(bodies))))
        memo.add(list(bodies), list(bodies.values()))
        at[unknown] = [place[w] for w in fresh]
        memo.used[at] = memo.batch
        return at

    def _piecewise(self, texts: pa.Array) -> list[bytes]:
        """The ids of regular texts: distinct pieces by the memo, put in place by one gather."""
        led = pc.binary_join_element_wise(FIRST, pc.replace_substring(texts, "\n", " \n"), "")
        parts = pc.split_pattern(led, " ")
        coded = parts.flatten().dictionary_encode()
        at = self._learn(coded.dictionary)
        ids, sizes = self.memo.ids, self.memo.sizes[at].astype(np.int64)
        starts = np.cumsum(self.memo.sizes, dtype=np.int64)[at] - sizes
        which = coded.indices.to_numpy()
        stops = np.cumsum(pc.list_value_length(parts).to_numpy())
        out: list[bytes] = []
        first, row = 0, 0
        while row < len(stops):  # rows of about GATHER pieces at a time, so what is held beside the ids stays small
            after = max(row + 1, int(np.searchsorted(stops, first + GATHER)))
            chosen = which[first : stops[after - 1]]
            lengths = sizes[chosen]
            ends = np.cumsum(lengths)
            places = np.arange(ends[-1]) + np.repeat(starts[chosen] - (ends - lengths), lengths)
            raw = ids[places]
            edges = [0, *ends[stops[row:after] - first - 1].tolist()]
            out += [raw[x:y].tobytes() for x, y in zip(edges, edges[1:])]
            first, row = int(stops[after - 1]), after
        return out

    def encode(self, texts: pa.Array | list[str]) -> list[bytes]:
        """The ids of each text as bytes; an empty text has none."""
        column = pa.array(texts, pa.string()) if isinstance(texts, list) else texts
        out: list[bytes] = []
        for part in within(pc.binary_length(column).to_pylist(), SLICE):
            out += self._encode(column.slice(part.start, part.stop - part.start))
        pa.default_memory_pool().release_unused()
        return out

    def _encode(self, column: pa.Array) -> list[bytes]:
        empty = pc.equal(pc.binary_length(column), 0)
        irregular = pc.and_not(pc.match_substring_regex(column, self.whole) if self.by_pieces else pa.array(np.ones(len(column), bool)), empty)
        out: list[bytes] = [b""] * len(column)
        regular = pc.invert(pc.or_(empty, irregular))
        for chosen, way in ((regular, self._piecewise), (irregular, lambda x: self.direct(x.to_pylist()))):
            rows = np.flatnonzero(chosen.to_numpy(zero_copy_only=False))
            if len(rows):
                for k, ids in zip(rows.tolist(), way(column.take(pa.array(rows)))):
                    out[k] = ids
        return out
