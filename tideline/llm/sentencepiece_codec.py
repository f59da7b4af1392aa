"""SentencePiece encoding and decoding over a suffix array.

A batch of texts is cut into chunks (a run of spaces and the characters up to the
next space or line break; no piece of the vocabulary reaches over such a cut, which
is checked when it is loaded).  The distinct new chunks of a batch are concatenated
and indexed by a suffix array; *every* piece of the vocabulary is looked up in it by
binary search, which gives the range of its occurrences.  These occurrences are the
edges of the lattice: (start, end, piece), sorted by position.  They are relaxed

* for a unigram model by position: the best-scored path to an edge's end is the best
  path to its start and the edge;
* for a BPE model by score: the best-scored edge of a chunk that covers exactly two
  neighbouring symbols joins them, the leftmost on a tie, until no edge does.  The
  sum over a path isn't what defines a BPE model's result, so relaxing by position
  would give other ids than the model's.

Characters without a piece become byte pieces, or the unknown piece where the
vocabulary has none.  As in the public library for a model with identity
normalisation and dummy prefix, one space is put before a text that isn't empty,
spaces are U+2581 inside pieces, and U+2581 in a text is read as a space.

Scale: one scan, no shuffle.  The vocabulary (half a MB) is read on the driver and
broadcast; a worker holds one slice of texts, the index of its new chunks and the ids of
at most ``MAX_CHUNKS`` chunks seen before.

Edge cases: null and empty texts have no ids; a very long chunk is joined over a
heap; repeated rows give equal rows; empty tables give none; other columns are
carried whatever their names (``ids``, ``n_ids``, ``round_trip`` replace theirs).
"""

from __future__ import annotations

import heapq
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tideline.llm.common import Shared, narrow_batches, text_slices, texts
from tideline.sources.tables import read_table

SPACE = "▁"
CHUNK = re.compile(r" +[^ \n]*|\n|[^ \n]+")
MAX_CHUNKS = 120_000
INDEX_BYTES = 1 << 19
ENCODE_BYTES = 2 << 20  # texts encoded at once: the more, the fewer lookups of all pieces
LONG_CHUNK = 400
_LEN, _ID = 6, 20  # bits of an edge's length and piece in its sort key


@dataclass
class Vocabulary:
    pieces: list[bytes]      # what a piece stands for, by id; spaces as U+2581
    scores: list[float]
    matched: list[int]       # ids that are looked for in texts
    byte_ids: list[int]      # id of each byte piece, empty without byte fallback
    unknown: int
    bpe: bool


def load_vocabulary(path: str) -> Vocabulary:
    """Read a SentencePiece model file on the driver."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as pb
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    proto = pb.ModelProto.FromString(open(path, "rb").read())
    spec, norm = proto.trainer_spec, proto.normalizer_spec
    if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.add_dummy_prefix or not norm.escape_whitespaces:
        raise ValueError("only identity normalisation with a dummy prefix is supported")
    n = sp.vocab_size()
    names = [sp.id_to_piece(i) for i in range(n)]
    ordinary = [i for i in range(n) if not (sp.is_control(i) or sp.is_byte(i) or sp.is_unknown(i) or sp.is_unused(i))]
    for i in ordinary:
        if SPACE in names[i].lstrip(SPACE) or "\n" in names[i] or not 0 < len(names[i].encode()) < 1 << _LEN:
            raise ValueError(f"piece {names[i]!r} reaches over a chunk or is too long")
    raw = [(bytes([int(x[3:5], 16)]) if sp.is_byte(i) else b"" if sp.is_control(i) else x.encode()) for i, x in enumerate(names)]
    raw[sp.unk_id()] = " ⁇ ".encode()
    byte_ids = sorted((i for i in range(n) if sp.is_byte(i)), key=lambda i: names[i])
    return Vocabulary(raw, [sp.get_score(i) for i in range(n)], ordinary, byte_ids if len(byte_ids) == 256 else [], sp.unk_id(), spec.model_type == 2)


def _words(buf: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The eight bytes from each position as one big-endian number."""
    x = np.zeros(len(at), np.uint64)
    for i in range(8):
        x = x << np.uint64(8) | buf[at + i]
    return x


class SuffixArray:
    """Suffixes of a buffer that begin a character, sorted by their first eight bytes.  Longer
    pieces are few; theirs are compared in full within the range of their first eight bytes."""

    def __init__(self, data: bytes):
        self.buf = np.frombuffer(data + b"\xff" * 64, np.uint8)
        body = self.buf[:len(data)]
        at = np.flatnonzero(((body & 0xC0) != 0x80) & (body != 0xFF))
        hi = _words(self.buf, at)
        order = np.argsort(hi)
        self.at, self.hi = at[order], hi[order]

    def edges(self, pieces: list[bytes], ids: list[int]) -> np.ndarray:
        """Sorted keys start << 26 | length << 20 | id of all occurrences."""
        size = np.array([len(p) for p in pieces])
        low = np.array([int.from_bytes(p[:8].ljust(8, b"\0"), "big") for p in pieces], np.uint64)
        high = np.array([int.from_bytes(p[:8].ljust(8, b"\xff"), "big") for p in pieces], np.uint64)
        a, b = np.searchsorted(self.hi, low, "left"), np.searchsorted(self.hi, high, "right")
        pids, key = np.array(ids, np.int64), []
        short = (size <= 8) & (b > a)
        n = (b - a)[short]
        first = np.repeat(a[short] - np.r_[0, np.cumsum(n)[:-1]], n) if len(n) else np.zeros(0, np.int64)
        start = self.at[first + np.arange(len(first))]
        key.append(start << (_LEN + _ID) | np.repeat(size[short] << _ID | pids[short], n))
        for i in np.flatnonzero((size > 8) & (b > a)).tolist():
            p, start = pieces[i], self.at[a[i]:b[i]]
            start = start[self.buf[start + 8] == p[8]]
            if len(p) > 9 and len(start):
                rest = np.frombuffer(p[9:], np.uint8)
                start = start[(self.buf[start[:, None] + 9 + np.arange(len(rest))] == rest).all(axis=1)]
            key.append(start << (_LEN + _ID) | (len(p) << _ID | ids[i]))
        key = np.concatenate(key)
        key.sort()
        return key


class Encoder:
    def __init__(self, vocab: Vocabulary):
        self.vocab = vocab
        self.pieces = [vocab.pieces[i] for i in vocab.matched]
        self.score = np.full(1 << _ID, -np.inf)
        self.score[:len(vocab.scores)] = vocab.scores
        self._reset()

    def _reset(self):
        self.known, self.flat, self.begin = {}, [np.zeros(0, np.int32)], [np.zeros(1, np.int64)]

    def encode(self, batch: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, number of ids of each text)."""
        if len(self.known) > MAX_CHUNKS:
            self._reset()
        cut = [CHUNK.findall(" " + t.replace(SPACE, " ")) if t else [] for t in batch]
        flat = [c for cs in cut for c in cs]
        new, size = [], 0
        for c in set(flat).difference(self.known):
            self.known[c] = len(self.known)
            new.append(c.replace(" ", SPACE).encode())
            size += len(new[-1])
            if size > INDEX_BYTES:
                self._learn(new)
                new, size = [], 0
        if new:
            self._learn(new)
        self.flat, self.begin = [np.concatenate(self.flat)], [np.concatenate(self.begin)]
        ids, begin = self.flat[0], self.begin[0]
        at = np.fromiter(map(self.known.__getitem__, flat), np.int64, len(flat))
        n = begin[at + 1] - begin[at]
        out = ids[np.repeat(begin[at] - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())] if len(at) else np.zeros(0, np.int32)
        ends = np.r_[0, np.cumsum([len(c) for c in cut])].astype(np.int64)
        return out, np.diff(np.r_[0, np.cumsum(n)][ends])

    def _learn(self, chunks: list[bytes]) -> None:
        """Encode chunks not seen before and append them to the known ones."""
        size = np.array([len(c) for c in chunks])
        begin = np.r_[0, np.cumsum(size + 1)[:-1]]
        index = SuffixArray(b"\xff".join(chunks))
        edges = index.edges(self.pieces, self.vocab.matched)
        starts, ends, ids = (self._merge if self.vocab.bpe else self._viterbi)(index, edges, begin, begin + size)
        if (ids < 0).any():  # characters without a piece
            known = np.flatnonzero(ids >= 0)
            rest = np.flatnonzero(ids < 0)
            if self.vocab.byte_ids:
                n = (ends - starts)[rest]
                at = np.repeat(starts[rest] - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())
                more = np.array(self.vocab.byte_ids)[index.buf[at]]
            else:
                at, more = starts[rest], np.full(len(rest), self.vocab.unknown)
            starts, ids = np.r_[starts[known], at], np.r_[ids[known], more]
            order = np.argsort(starts, kind="stable")
            starts, ids = starts[order], ids[order]
        self.flat.append(ids.astype(np.int32))
        self.begin.append(self.begin[-1][-1] + np.searchsorted(starts, begin[1:]) if len(begin) > 1 else np.zeros(0, np.int64))
        self.begin.append(np.array([sum(map(len, self.flat))]))

    def _symbols(self, index: SuffixArray, begin: np.ndarray, end: np.ndarray):
        at = np.sort(index.at)
        stop = np.r_[at[1:], end[-1]]
        chunk = np.searchsorted(begin, at, "right") - 1
        return at, np.minimum(stop, end[chunk]), chunk

    def _piece(self, edges: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Piece of the edge from a to b, -1 where there is none."""
        if not len(edges):
            return np.full(len(a), -1, np.int64)
        size = b - a
        ok = size < 1 << _LEN
        want = (a << _LEN | np.where(ok, size, 0)) << _ID
        i = np.minimum(np.searchsorted(edges, want), len(edges) - 1)
        return np.where(ok & (edges[i] >> _ID == want >> _ID), edges[i] & (1 << _ID) - 1, -1)

    def _merge(self, index, edges, begin, end):
        """BPE: join the best neighbouring pair of every chunk at once until none is left."""
        a, b, chunk = self._symbols(index, begin, end)
        done = []
        long = np.bincount(chunk, minlength=len(begin))[chunk] > LONG_CHUNK
        if long.any():
            for c in np.unique(chunk[long]).tolist():
                mine = chunk == c
                done.append(self._merge_long(edges, a[mine], b[mine]))
            a, b, chunk = a[~long], b[~long], chunk[~long]

        def score(i):  # of joining symbols i and i + 1
            j = np.minimum(i + 1, len(a) - 1)
            piece = self._piece(edges, a[i], b[j])
            return np.where((piece >= 0) & (j > i) & (chunk[i] == chunk[j]), self.score[piece], -np.inf)

        best = score(np.arange(len(a)))
        while len(a):
            first = np.flatnonzero(np.r_[True, chunk[1:] != chunk[:-1]])
            n = np.diff(np.r_[first, len(a)])
            top = np.maximum.reduceat(best, first)
            open_ = np.repeat(np.isfinite(top), n)
            if not open_.all():
                done.append((a[~open_], b[~open_]))
            hit = np.flatnonzero((best == np.repeat(top, n)) & open_)
            hit = hit[np.r_[True, chunk[hit][1:] != chunk[hit][:-1]]] if len(hit) else hit
            b[hit] = b[hit + 1]
            keep = open_
            keep[hit + 1] = False
            at = (np.cumsum(keep) - 1)[hit]
            a, b, chunk, best = a[keep], b[keep], chunk[keep], best[keep]
            if len(a):
                near = np.r_[at, np.maximum(at, 1) - 1]
                best[near] = score(near)
        a, b = np.concatenate([x for x, _ in done]), np.concatenate([y for _, y in done])
        order = np.argsort(a)
        a, b = a[order], b[order]
        return a, b, self._piece(edges, a, b)

    def _merge_long(self, edges, a, b):
        """The same for one long chunk, over a heap."""
        a, b, score = a.tolist(), b.tolist(), self.score
        left, right, heap = list(range(-1, len(a) - 1)), [*range(1, len(a)), -1], []

        def push(i):
            j = right[i]
            if j >= 0 and b[j] - a[i] < 1 << _LEN:
                want = (a[i] << _LEN | b[j] - a[i]) << _ID
                k = int(np.searchsorted(edges, want))
                if k < len(edges) and edges[k] >> _ID == want >> _ID:
                    heapq.heappush(heap, (-score[edges[k] & (1 << _ID) - 1], a[i], i, b[j]))

        for i in range(len(a)):
            push(i)
        while heap:
            _, x, i, y = heapq.heappop(heap)
            j = right[i]
            if b[i] < 0 or a[i] != x or j < 0 or b[j] != y:
                continue
            b[i], b[j], right[i] = b[j], -1, right[j]
            if right[j] >= 0:
                left[right[j]] = i
            if left[i] >= 0:
                push(left[i])
            push(i)
        live = [i for i in range(len(a)) if b[i] >= 0]
        return np.array([a[i] for i in live]), np.array([b[i] for i in live])

    def _viterbi(self, index, edges, begin, end):
        """Unigram: relax the edges by position, the same offset of all chunks at once."""
        a, b, chunk = self._symbols(index, begin, end)
        # a character without a piece is an edge of its own, ten below the worst score
        lone = self._piece(edges, a, b) < 0
        start = np.r_[edges >> (_LEN + _ID), a[lone]]
        stop = np.r_[start[:len(edges)] + (edges >> _ID & (1 << _LEN) - 1), b[lone]]
        piece = np.r_[edges & (1 << _ID) - 1, np.full(lone.sum(), -1)]
        worst = min(self.vocab.scores[i] for i in self.vocab.matched) - 10
        cost = np.where(piece >= 0, self.score[piece], worst)
        offset = start - begin[np.searchsorted(begin, start, "right") - 1]
        order = np.lexsort((stop, start, offset))
        start, stop, piece, cost, offset = (x[order] for x in (start, stop, piece, cost, offset))
        best, back = np.full(end[-1] + 2, -np.inf), np.full(end[-1] + 2, -1, np.int64)
        best[begin] = 0
        cuts = np.flatnonzero(np.r_[True, offset[1:] != offset[:-1]]).tolist() + [len(offset)]
        for x, y in zip(cuts, cuts[1:]):
            total = best[start[x:y]] + cost[x:y]
            better = np.flatnonzero(total > best[stop[x:y]])
            best[stop[x:y][better]] = total[better]
            back[stop[x:y][better]] = x + better
        used, now = [], end[end > begin]
        while len(now):
            e = back[now]
            used.append(e)
            now = start[e]
            now = now[~np.isin(now, begin)]
        used = np.sort(np.concatenate(used)) if used else np.zeros(0, np.int64)
        used = used[np.argsort(start[used], kind="stable")]
        return start[used], stop[used], piece[used]


def decode(ids: list[int], pieces: list[bytes]) -> str:
    text = b"".join(map(pieces.__getitem__, ids)).decode("utf-8", "replace").replace(SPACE, " ")
    return text[1:] if text.startswith(" ") else text


def encode_documents(docs: DataFrame, model_path: str, text: str = "text", carry: list[str] | None = None,
                     check: bool = False) -> DataFrame:
    """The ``carry`` columns (default: all), ids and n_ids; with ``check`` also round_trip:
    whether decoding the ids gives the text back (U+2581 read as a space)."""
    narrow_batches(docs.sparkSession)
    shared = Shared(docs.sparkSession, load_vocabulary(model_path))
    added = ["ids", "n_ids", *["round_trip"] * check]
    carry = [c for c in (docs.columns if carry is None else carry) if c not in added]
    kinds = {f.name: f for f in docs.schema}
    schema = T.StructType([*(kinds[c] for c in carry), T.StructField("ids", T.ArrayType(T.IntegerType(), False)),
                           T.StructField("n_ids", T.LongType()), *[T.StructField("round_trip", T.BooleanType())] * check])
    source = docs.select(*carry, F.col(text).alias("__text"))

    def task(batches):
        encoder = Encoder(shared.value)
        for batch in text_slices(batches, "__text", ENCODE_BYTES):
            raw = texts(batch, "__text")
            ids, n = encoder.encode(raw)
            ends = np.r_[0, np.cumsum(n)]
            cols = [*(batch.column(c) for c in carry), pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids)), pa.array(n)]
            if check:
                cols.append(pa.array([decode(ids[a:b].tolist(), shared.value.pieces) == t.replace(SPACE, " ") for t, a, b in zip(raw, ends, ends[1:])], pa.bool_()))
            yield pa.RecordBatch.from_arrays(cols, names=[*carry, *added])

    return source.mapInArrow(task, schema)


def decode_documents(encoded: DataFrame, model_path: str, ids: str = "ids", out: str = "text") -> DataFrame:
    """All columns and the decoded text; null ids give a null text."""
    shared = Shared(encoded.sparkSession, load_vocabulary(model_path).pieces)
    kept = [f for f in encoded.schema if f.name != out]

    def task(batches):
        for batch in batches:
            made = [None if x is None else decode(x, shared.value) for x in batch.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in kept), pa.array(made, pa.string())], names=[*(f.name for f in kept), out])

    return encoded.mapInArrow(task, T.StructType([*kept, T.StructField(out, T.StringType())]))


def public_model() -> str:
    """Place of the public SentencePiece vocabulary that this machine brings."""
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document and whether decoding them gives the text back."""
    return encode_documents(read_table(spark, sf_dir, "documents"), public_model(), carry=["doc_id"], check=True)
