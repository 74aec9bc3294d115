"""Byte-level BPE encoding and decoding with a minimal acyclic transducer.

Method. A Spark job counts the pre-tokens ("words") of all texts; the most
frequent ones are compiled into a minimal acyclic automaton: words sorted,
added incrementally, equal suffix states shared, and every state knows how
many words end below it, so the path of a word adds up to its number, which
selects its token ids (the transducer's output). The automaton is one file of
flat arrays that ``SparkContext.addFile`` ships and tasks memory-map. All
distinct words of a slice walk it together (numpy, one step per byte); words
that leave it are merged exactly by rank.

Texts are cut into words by vectorised rules over the byte buffer that equal
the pre-tokenizer of the tokenizers library (character classes are asked from
the library, once per distinct character). Batches are processed in slices of
a few MB, a single longer text alone; nothing is cut or dropped.

Defined results: a NULL text counts as empty (0 tokens, sha256 of nothing);
rows keep their order and number, repeated rows are encoded like any other,
an empty table gives an empty result; columns beyond the id and the text are
not read, so any other names may be present.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.tables import share, stored
from cohortlens.llm.words import buffer_of, pieces, text_slices

LEXICON_WORDS = 50_000
CACHE_WORDS = 300_000
_LETTER, _NUMBER, _OTHER, _GAP = 0, 1, 2, 3


def _byte_alphabet() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies."""
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, extra = {}, 0
    for b in range(256):
        if b in keep:
            out[b] = chr(b)
        else:
            out[b] = chr(256 + extra)
            extra += 1
    return [out[b] for b in range(256)]


class HashIndex:
    """Open-addressed table over distinct non-negative int64 keys for
    vectorised lookups: position of a key in ``keys``, -1 if absent."""

    def __init__(self, slots: np.ndarray, place: np.ndarray):
        self.slots, self.place = slots, place
        self.shift = np.uint64(64 - (len(slots).bit_length() - 1))

    @classmethod
    def of(cls, keys: np.ndarray) -> HashIndex:
        bits = max(8, (4 * len(keys)).bit_length())
        table = cls(np.full(1 << bits, -1, np.int64), np.full(1 << bits, -1, np.int64))
        left, at = np.arange(len(keys)), table._home(keys)
        while len(left):
            free = table.slots[at] == -1
            one = np.zeros(len(left), bool)
            one[np.unique(at, return_index=True)[1]] = True
            put = free & one
            table.slots[at[put]], table.place[at[put]] = keys[left[put]], left[put]
            left, at = left[~put], at[~put]
            at = np.where(table.slots[at] == -1, at, (at + 1) & (len(table.slots) - 1))
        return table

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        at = self._home(keys)
        got = self.slots[at]
        out = np.where(got == keys, self.place[at], -1)
        left = np.flatnonzero((got != keys) & (got != -1))
        at = at[left]
        while len(left):
            at = (at + 1) & (len(self.slots) - 1)
            got = self.slots[at]
            hit = got == keys[left]
            out[left[hit]] = self.place[at[hit]]
            on = ~hit & (got != -1)
            left, at = left[on], at[on]
        return out


class ByteBPE:
    """A byte-level BPE vocabulary file with vectorised encode and decode."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        to_byte = {c: b for b, c in enumerate(_byte_alphabet())}
        vocab = spec["model"]["vocab"]
        self.special = {t["content"].encode(): t["id"] for t in spec.get("added_tokens", [])}
        self.n = max([*vocab.values(), *self.special.values()]) + 1
        token = [b""] * self.n
        for text, i in vocab.items():
            token[i] = text.encode() if text.encode() in self.special else bytes(to_byte[c] for c in text)
        for content, i in self.special.items():
            token[i] = content
        self.first = np.array([vocab[c] for c in _byte_alphabet()], np.int64)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        key = np.array([vocab[a] * self.n + vocab[b] for a, b in pairs], np.int64)
        into = np.array([vocab[a + b] for a, b in pairs], np.int64)
        self.pairs, self.into = HashIndex.of(key), into  # the position of a pair is its rank
        size = np.array([len(t) for t in token], np.int64)
        self.token_at = np.concatenate(([0], np.cumsum(size)))
        self.token_bytes = np.frombuffer(b"".join(token), np.uint8)
        self._class: dict[int, int] = {}
        self._cache: dict[bytes, int] = {}
        self._splitter = None
        self._forget()

    # -- words -------------------------------------------------------------

    def _class_of(self, point: int) -> int:
        if point not in self._class:
            if self._splitter is None:
                from tokenizers.pre_tokenizers import ByteLevel
                self._splitter = ByteLevel(add_prefix_space=False)
            joins = [len(self._splitter.pre_tokenize_str(x + chr(point))) == 1 for x in "a1!"]
            self._class[point] = joins.index(True) if any(joins) else _GAP
        return self._class[point]

    def _classes(self, data: np.ndarray) -> np.ndarray:
        """Character class of every byte (all bytes of a character alike)."""
        table = np.array([self._class_of(i) for i in range(128)] + [0] * 128, np.int8)
        cls = table[data]
        lead = np.flatnonzero(data >= 0xC0)
        if len(lead):
            b0 = data[lead].astype(np.int64)
            extra = 1 + (b0 >= 0xE0) + (b0 >= 0xF0)
            point = b0 & np.where(extra == 1, 0x1F, np.where(extra == 2, 0x0F, 0x07))
            for k in (1, 2, 3):
                on = extra >= k
                point[on] = (point[on] << 6) | (data[lead[on] + k] & 0x3F)
            distinct, back = np.unique(point, return_inverse=True)
            of = np.array([self._class_of(int(p)) for p in distinct], np.int8)[back]
            cls[lead] = of
            for k in (1, 2, 3):
                on = extra >= k
                cls[lead[on] + k] = of[on]
        return cls

    def word_bounds(self, data: np.ndarray, offs: np.ndarray) -> np.ndarray:
        """Start of every word of the buffer, plus its length at the end."""
        n = len(data)
        if not n:
            return np.zeros(1, np.int64)
        row = np.zeros(n + 1, bool)
        row[offs] = True
        fixed = []
        raw = data.tobytes()
        for content in self.special:
            at = raw.find(content)
            while at >= 0:
                end = at + len(content)
                if not row[at + 1:end].any():
                    fixed.append((at, end))
                    at = raw.find(content, end)
                else:
                    at = raw.find(content, at + 1)
        for at, end in fixed:
            row[at] = row[end] = True
        cls = self._classes(data)
        begins = (data & 0xC0) != 0x80
        run = row[:-1].copy()
        run[1:] |= cls[1:] != cls[:-1]
        starts = run.copy()
        # a run after white space: the last white-space character goes apart, a blank joins the run
        i = np.flatnonzero(run & (cls != _GAP) & ~row[:-1])
        i = i[cls[i - 1] == _GAP]
        q = i - 1
        while len(back := np.flatnonzero(~begins[q])):
            q[back] -= 1
        starts[q] = True
        starts[i[data[i - 1] == 32]] = False
        # contractions, where a word starts at the apostrophe
        i = np.flatnonzero((data[:-1] == 39) & starts[:-1]) if n > 1 else np.empty(0, np.int64)
        i = i[~row[i + 1]]
        nxt = data[i + 1]
        size = np.where(np.isin(nxt, np.frombuffer(b"stmd", np.uint8)), 1, 0)
        two = (i + 2 < n)
        second = np.where(two, data[np.minimum(i + 2, n - 1)], 0)
        two &= ~row[np.minimum(i + 2, n)]
        size[two & (((nxt == 114) | (nxt == 118)) & (second == 101) | (nxt == 108) & (second == 108))] = 2
        i, size = i[size > 0], size[size > 0]
        starts[i + 1] = False
        after = i + 1 + size
        starts[after[after < n]] = True
        for at, end in fixed:
            starts[at] = True
            starts[at + 1:end] = False
        return np.append(np.flatnonzero(starts), n)

    # -- merges ------------------------------------------------------------

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Exact merges of many words at once: (ids, offsets). Each round
        merges every occurrence, left to right, of each word's lowest-ranked
        pair; words without a known pair are done."""
        size = np.array([len(w) for w in words], np.int64)
        sym = self.first[np.frombuffer(b"".join(words), np.uint8)]
        word = np.repeat(np.arange(len(words)), size)
        done_sym, done_word = [], []
        none = np.iinfo(np.int64).max
        while len(sym):
            rank = np.full(len(sym), none)
            into = np.zeros(len(sym), np.int64)
            near = np.flatnonzero(word[:-1] == word[1:])
            key = sym[near] * self.n + sym[near + 1]
            pos = self.pairs.find(key)
            hit = pos >= 0
            near, pos = near[hit], pos[hit]
            rank[near], into[near] = pos, self.into[pos]
            begin = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            low = np.repeat(np.minimum.reduceat(rank, begin), np.diff(np.r_[begin, len(sym)]))
            live = low != none
            done_sym.append(sym[~live])
            done_word.append(word[~live])
            sym, word, into, take = sym[live], word[live], into[live], (rank == low)[live]
            if not len(sym):
                break
            if (take[1:] & take[:-1]).any():  # a pair over itself (aaa): every second place of a run
                idx = np.arange(len(take))
                head = np.maximum.accumulate(np.where(take & ~np.r_[False, take[:-1]], idx, 0))
                take &= (idx - head) % 2 == 0
            sym[take] = into[take]
            keep = ~np.r_[False, take[:-1]]
            sym, word = sym[keep], word[keep]
        sym, word = np.concatenate([*done_sym, sym]), np.concatenate([*done_word, word])
        order = np.argsort(word, kind="stable")
        return sym[order], np.concatenate(([0], np.cumsum(np.bincount(word, minlength=len(words)))))

    def _ids_of(self, distinct: pa.Array, lexicon: Lexicon | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Token ids of distinct words: (flat ids, start and size of each)."""
        if len(self._cache) > CACHE_WORDS:
            self._forget()
        found = lexicon.lookup(distinct) if lexicon is not None else np.full(len(distinct), -1, np.int64)
        rest = np.flatnonzero(found < 0)
        words = distinct.take(pa.array(rest)).to_pylist()
        entry = [*map(self._cache.get, words)]
        new = [w for w, e in zip(words, entry) if e is None]
        if new:
            ids, at = self.merge(new)
            known, base = len(self._cache), len(self._ids)
            self._ids = np.concatenate((self._ids, ids))
            self._at = np.concatenate((self._at, base + at[1:]))
            self._cache.update(zip(new, range(known, known + len(new))))
            entry = [*map(self._cache.get, words)]
        entry = np.array(entry, np.int64)
        start, size = np.empty(len(distinct), np.int64), np.empty(len(distinct), np.int64)
        start[rest], size[rest] = self._at[entry], self._at[entry + 1] - self._at[entry]
        if len(rest) == len(distinct):
            return self._ids, start, size
        known = np.flatnonzero(found >= 0)
        begin = lexicon.ids_at[found[known]]
        start[known], size[known] = len(self._ids) + begin, lexicon.ids_at[found[known] + 1] - begin
        return np.concatenate((self._ids, lexicon.ids)), start, size

    def _forget(self) -> None:
        """Empty the store of merged words; special tokens are entries of their own."""
        self._cache = {w: i for i, w in enumerate(self.special)}
        self._ids = np.array([*self.special.values()], np.int64)
        self._at = np.arange(len(self.special) + 1)

    def encode(self, column: pa.Array, lexicon: Lexicon | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of a column of texts: (uint32 ids, row offsets)."""
        data, offs = buffer_of(column)
        bounds = self.word_bounds(data, offs)
        if len(bounds) < 2:
            return np.empty(0, np.uint32), np.zeros(len(offs), np.int64)
        coded = pieces(data, bounds).dictionary_encode()
        flat, start, size = self._ids_of(coded.dictionary, lexicon)
        which = np.asarray(coded.indices)
        size = size[which]
        ends = np.cumsum(size)
        ids = flat[np.arange(ends[-1]) + np.repeat(start[which] - (ends - size), size)].astype("<u4")
        rows = np.concatenate(([0], ends))[np.searchsorted(bounds, offs)]
        return ids, rows

    def decode(self, ids: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of token ids: (bytes, row offsets). A decoded text is these
        bytes read as UTF-8 with invalid parts replaced."""
        size = np.diff(self.token_at)[ids]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        out = self.token_bytes[np.arange(total) + np.repeat(self.token_at[:-1][ids] - (ends - size), size)]
        return out, np.concatenate(([0], ends))[rows]


# -- lexicon -------------------------------------------------------------------

class Lexicon:
    """Memory-mapped minimal acyclic transducer: word -> number -> token ids."""

    _FIELDS = ("slots", "place", "target", "skip", "final", "ids", "ids_at")

    def __init__(self, path: str):
        raw = np.memmap(path, np.int64, "r")
        at = len(self._FIELDS)
        for name, size in zip(self._FIELDS, raw[:at].tolist()):
            setattr(self, name, raw[at:at + size])
            at += size
        self.edges = HashIndex(self.slots, self.place)

    @staticmethod
    def build(words: list[bytes], bpe: ByteBPE) -> np.ndarray:
        """Compile ``words`` (any order, repeats and special tokens allowed; the
        latter are left out) into the content of a lexicon file."""
        words = sorted(set(words) - set(bpe.special))
        register: dict[tuple, int] = {}
        states: list[tuple] = []  # (final, ((byte, target), ...)) of closed states

        def close(final: bool, edges: list) -> int:
            sig = (final, tuple(edges))
            if sig not in register:
                register[sig] = len(states)
                states.append(sig)
            return register[sig]

        path_final, path_edges, last = [False], [[]], b""
        for w in words:
            same = 0
            while same < min(len(w), len(last)) and w[same] == last[same]:
                same += 1
            for d in range(len(last), same, -1):
                target = close(path_final.pop(), path_edges.pop())
                path_edges[d - 1].append((last[d - 1], target))
            for _ in range(same, len(w)):
                path_final.append(False)
                path_edges.append([])
            path_final[len(w)] = True
            last = w
        for d in range(len(last), 0, -1):
            target = close(path_final.pop(), path_edges.pop())
            path_edges[d - 1].append((last[d - 1], target))
        root = close(path_final[0], path_edges[0])
        below = []  # number of words that end at or below a state (targets close before sources)
        for final, edges in states:
            below.append(int(final) + sum(below[t] for _, t in edges))
        key, target, skip = [], [], []
        name = {root: 0} | {s: i + (i < root) for i, s in enumerate(range(len(states))) if s != root}
        for s, (final, edges) in enumerate(states):
            before = int(final)
            for b, t in sorted(edges):
                key.append(name[s] * 256 + b)
                target.append(name[t])
                skip.append(before)
                before += below[t]
        edges = HashIndex.of(np.array(key, np.int64))
        ends = np.zeros(len(states), np.int64)
        for s, (final, _) in enumerate(states):
            ends[name[s]] = final
        ids, ids_at = bpe.merge(words) if words else (np.empty(0, np.int64), np.zeros(1, np.int64))
        parts = [edges.slots, edges.place, np.array(target, np.int64), np.array(skip, np.int64), ends, ids, ids_at]
        return np.concatenate([np.array([len(p) for p in parts], np.int64), *parts])

    def lookup(self, words: pa.Array) -> np.ndarray:
        """Number of each word in the lexicon, -1 where it has none."""
        data = words.buffers()[2]
        offs = np.frombuffer(words.buffers()[1], np.int64)[words.offset:words.offset + len(words) + 1]
        data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
        number = np.full(len(words), -1, np.int64)
        live = np.arange(len(words))
        state = np.zeros(len(words), np.int64)
        total = np.zeros(len(words), np.int64)
        at, end = offs[:-1].copy(), offs[1:]
        while len(live):
            over = at[live] == end[live]
            done = live[over]
            number[done] = np.where(self.final[state[done]] == 1, total[done], -1)
            live = live[~over]
            pos = self.edges.find(state[live] * 256 + data[at[live]])
            live, pos = live[pos >= 0], pos[pos >= 0]
            state[live] = self.target[pos]
            total[live] += self.skip[pos]
            at[live] += 1
        return number


_OPEN: dict = {}


def bpe_of(path: str) -> ByteBPE:
    """The vocabulary of ``path``, read once per Python process."""
    if path not in _OPEN:
        _OPEN[path] = ByteBPE(path)
    return _OPEN[path]


def _lexicon_of(name: str) -> Lexicon:
    if name not in _OPEN:
        _OPEN[name] = Lexicon(SparkFiles.get(name))
    return _OPEN[name]


def word_counts(docs: DataFrame, vocab: str, column: str = "text") -> DataFrame:
    """(word binary, n long) over all texts; words are counted per slice in
    Arrow before they are shuffled."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = bpe_of(vocab)
        for batch in batches:
            for part in text_slices(batch, column):
                data, offs = buffer_of(part.column(column))
                got = pc.value_counts(pieces(data, bpe.word_bounds(data, offs)))
                words = got.field("values").cast(pa.binary())
                yield pa.RecordBatch.from_arrays([words, got.field("counts")], ["word", "n"])

    return (docs.select(column).mapInArrow(count, "word binary, n long")
            .groupBy("word").agg(F.sum("n").alias("n")))


def build_lexicon(docs: DataFrame, vocab: str, size: int = LEXICON_WORDS, column: str = "text",
                  max_bytes: int = 64) -> str:
    """Compile the most frequent words of all texts, ``size`` at most, and ship
    the file; returns its name for the tasks. The frequency from which words
    are taken is the lowest step (eighths of a power of two) that no more than
    ``size`` words reach, so the driver gets a bounded number of rows. Words
    over ``max_bytes`` are left to the exact merges."""
    spark = docs.sparkSession
    special = [F.lit(s) for s in bpe_of(vocab).special]
    counts = stored(word_counts(docs, vocab, column)
                    .where((F.length("word") <= max_bytes) & (F.col("n") > 1) & ~F.col("word").isin(special))
                    .withColumn("step", F.floor(F.log2("n") * 8)), "words")
    reached, least = 0, None
    for r in sorted(counts.groupBy("step").agg(F.count("*").alias("k")).collect(), key=lambda r: -r.step):
        reached += r.k
        if reached > size:
            break
        least = r.step
    frequent = counts.where(F.col("step") >= least).select("word").collect() if least is not None else []
    name = f"lexicon-{uuid.uuid4().hex}.bin"
    share(spark, name, Lexicon.build([bytes(r.word) for r in frequent], bpe_of(vocab)).tobytes())
    return name


def encode(docs: DataFrame, vocab: str, lexicon: str | None = None, id_col: str = "doc_id",
           column: str = "text") -> DataFrame:
    """(id_col, ids array<int>) per row; NULL text gives an empty array."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, lex = bpe_of(vocab), _lexicon_of(lexicon) if lexicon else None
        for batch in batches:
            for part in text_slices(batch, column):
                ids, rows = bpe.encode(part.column(column), lex)
                lists = pa.ListArray.from_arrays(pa.array(rows.astype(np.int32)), pa.array(ids.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([part.column(id_col), lists], [id_col, "ids"])

    return docs.select(id_col, column).mapInArrow(run, f"`{id_col}` {kind}, ids array<int>")


def decode(tokens: DataFrame, vocab: str, id_col: str = "doc_id", column: str = "ids") -> DataFrame:
    """(id_col, text) of token id arrays; invalid UTF-8 is replaced."""
    kind = tokens.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = bpe_of(vocab)
        for batch in batches:
            lists = pc.fill_null(batch.column(column), pa.scalar([], pa.list_(pa.int32())))
            rows = np.asarray(lists.offsets).astype(np.int64)
            ids = np.asarray(lists.values)
            out, at = bpe.decode(ids[rows[0]:rows[-1]], rows - rows[0])
            raw, at = out.tobytes(), at.tolist()
            texts = [raw[a:b].decode("utf-8", "replace") for a, b in zip(at, at[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(id_col), pa.array(texts, pa.string())], [id_col, "text"])

    return tokens.select(id_col, column).mapInArrow(run, f"`{id_col}` {kind}, text string")


def round_trip(docs: DataFrame, vocab: str, lexicon: str | None = None, id_col: str = "doc_id",
               column: str = "text") -> DataFrame:
    """(id_col, n_tokens, ids_sha256, decoded_sha256) per row: encode, then
    decode the ids, without carrying ids or texts out of the task."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, lex = bpe_of(vocab), _lexicon_of(lexicon) if lexicon else None
        sha = lambda b: hashlib.sha256(b).hexdigest()
        for batch in batches:
            for part in text_slices(batch, column):
                ids, rows = bpe.encode(part.column(column), lex)
                out, at = bpe.decode(ids, rows)
                raw_ids, raw, rows, at = ids.tobytes(), out.tobytes(), rows.tolist(), at.tolist()
                yield pa.RecordBatch.from_arrays([
                    part.column(id_col), pa.array([b - a for a, b in zip(rows, rows[1:])], pa.int64()),
                    pa.array([sha(raw_ids[4 * a:4 * b]) for a, b in zip(rows, rows[1:])]),
                    pa.array([sha(raw[a:b].decode("utf-8", "replace").encode()) for a, b in zip(at, at[1:])]),
                ], [id_col, "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(id_col, column).mapInArrow(
        run, f"`{id_col}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
