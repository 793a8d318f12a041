"""SentencePiece encoding by the best-scoring segmentation, and decoding.

A text's encoding is the path of highest total score through the lattice of its pieces. Between
two characters that stand side by side in no piece every path has a cut, so ordinary texts are
segmented unit by unit, each distinct unit of a batch once, by the sentencepiece library.

A giant text is split into chunks. A piece may reach over a chunk's end by fewer characters than
the longest piece has: that reach is the state at the boundary. Each chunk gives the max-plus
matrix of best scores from each entering to each leaving state; matrices are combined in a
parallel scan to the best score of each state before each chunk. From these a chunk knows which
entering state leads to which leaving one (ties as in a text that is not split), and with its two
states known it is traced back by itself.
"""

from __future__ import annotations

import functools
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from sentencepiece import sentencepiece_model_pb2

from nestweave.llm.storage import stage
from nestweave.llm.words import SMALL_SLICE, slices, units

#: Characters of a chunk; longer texts are split.
CHUNK = 32_768
#: The library adds scores in single precision. It gets units of so many characters at most, whose
#: characters all have pieces above a score, and with lower scores raised to one that still no
#: best path of such a unit can take: its sums are then whole numbers that it adds exactly.
LONG_UNIT = 64
LEAST_SCORE = -32_768.0
#: Bytes that a worker remembers units in at most (about) before it starts anew, and those of an entry besides.
REMEMBERED = 16 << 20
_ENTRY = 200
#: Ids that are turned into bytes at a time.
IDS = 1 << 16
BLANK = "▁"
#: What an unknown character scores below the lowest piece: the library's value.
UNKNOWN_PENALTY = 10.0
_NEVER = -np.inf


@dataclass
class Pieces:
    """A vocabulary: scores and ids of its pieces, bytes of each id, neighbouring characters."""

    ids: dict[str, int]
    scores: dict[str, float]
    bytes_of: list[bytes]
    byte_ids: dict[int, int]
    unknown: int
    unknown_score: float
    longest: int
    pairs: np.ndarray
    plain: frozenset[str]
    alone: np.ndarray
    library: sentencepiece.SentencePieceProcessor
    memory: dict[str, bytes] = field(default_factory=dict)
    remembered: int = 0


@functools.lru_cache(maxsize=2)
def pieces(model: bytes) -> Pieces:
    """The vocabulary of a model file's content; normalising models are refused."""
    spec = sentencepiece_model_pb2.ModelProto()
    spec.ParseFromString(model)
    rules = spec.normalizer_spec
    if rules.precompiled_charsmap or rules.remove_extra_whitespaces or not rules.escape_whitespaces:
        raise ValueError("only models that leave texts as they are")
    ids, scores, bytes_of, byte_ids, unknown = {}, {}, [], {}, 0
    for k, piece in enumerate(spec.pieces):
        text = piece.piece
        bytes_of.append(bytes_of_piece(piece))
        if piece.type == piece.NORMAL:
            ids[text], scores[text] = k, piece.score
        elif piece.type == piece.BYTE:
            byte_ids[int(text[3:5], 16)] = k
        elif piece.type == piece.UNKNOWN:
            unknown = k
    if any(BLANK in text.lstrip(BLANK) for text in ids):
        raise ValueError("only models whose pieces hold blanks at their start")
    side = {(ord(a) << 32) | ord(b) for text in ids for a, b in zip(text, text[1:], strict=False)}
    spec.trainer_spec.model_type = spec.trainer_spec.UNIGRAM
    rules.add_dummy_prefix = False
    for piece in spec.pieces:
        piece.score = max(piece.score, LONG_UNIT * LEAST_SCORE)
    library = sentencepiece.SentencePieceProcessor(model_proto=spec.SerializeToString())
    lowest = min(scores.values())
    longest = max(map(len, ids))
    pairs = np.array(sorted(side), np.uint64)
    plain = frozenset(t for t, s in scores.items() if len(t) == 1 and s > LEAST_SCORE)
    joined = {c for t in ids if len(t) > 1 for c in t}
    alone = np.zeros(256, bool)
    alone[[b for b in range(128) if chr(b) not in joined and b != 32]] = True
    return Pieces(
        ids, scores, bytes_of, byte_ids, unknown, lowest - UNKNOWN_PENALTY, longest, pairs, plain, alone, library
    )


def cuts(text: str, known: Pieces) -> np.ndarray:
    """Positions inside the text that no piece reaches over."""
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    pair = (code[:-1] << np.uint64(32)) | code[1:]
    at = np.minimum(np.searchsorted(known.pairs, pair), len(known.pairs) - 1)
    return np.flatnonzero(known.pairs[at] != pair) + 1


def _steps(text: str, at: int, known: Pieces) -> Iterator[tuple[int, float]]:
    """Length and score of every lattice edge from position ``at``."""
    single = False
    for size in range(1, min(known.longest, len(text) - at) + 1):
        score = known.scores.get(text[at : at + size])
        if score is not None:
            single |= size == 1
            yield size, score
    if not single and at < len(text):
        yield 1, known.unknown_score


def forward(
    text: str, last_start: int, known: Pieces, first: int = 0, entries: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Best score to each position from ``first`` over pieces that start before ``last_start``.

    With the start of the last piece of that path; of equal scores the longest last piece wins.
    With ``entries``, the scores that positions 0, 1, ... are entered with: by pieces that start
    earlier, so that they win over equal ones.
    """
    best = np.full(len(text) + 1, _NEVER)
    start = np.full(len(text) + 1, -1)
    if entries is None:
        best[first] = 0.0
    else:
        best[: len(entries)] = entries[: len(best)]
    for at in range(first, last_start):
        if best[at] > _NEVER:
            for size, score in _steps(text, at, known):
                if best[at] + score > best[at + size]:
                    best[at + size], start[at + size] = best[at] + score, at
    return best, start


def _trace(text: str, start: np.ndarray, end: int, first: int, known: Pieces) -> list[int]:
    """Ids along the best path from ``first`` to ``end``."""
    parts = []
    while end > first:
        parts.append(text[start[end] : end])
        end = start[end]
    return [i for part in reversed(parts) for i in _ids(part, known)]


def _ids(part: str, known: Pieces) -> list[int]:
    if part in known.ids:
        return [known.ids[part]]
    if not known.byte_ids:
        return [known.unknown]
    return [known.byte_ids[b] for b in part.encode()]


def best_ids(texts: list[str], known: Pieces) -> list[list[int]]:
    """Ids of the best segmentation of each text (blanks as in pieces)."""
    parts, owners = [], []
    simple: dict[str, bool] = {}  # each distinct part, segmented once
    for k, text in enumerate(texts):
        if _simple(text, known):
            simple[text] = True
            parts.append(text)
            owners.append(k)
        else:
            bounds = [0, *cuts(text, known).tolist(), len(text)]
            fresh = [text[a:b] for a, b in zip(bounds, bounds[1:], strict=False)]
            parts += fresh
            owners += [k] * len(fresh)
            simple |= {part: _simple(part, known) for part in set(fresh) if part not in simple}
    easy = [part for part, by_library in simple.items() if by_library]
    ids = dict(zip(easy, known.library.encode(easy, out_type=int, num_threads=1), strict=True))
    for part in simple:
        if part not in ids:
            ids[part] = _trace(part, forward(part, len(part), known)[1], len(part), 0, known)
    out: list[list[int]] = [[] for _ in texts]
    for part, owner in zip(parts, owners, strict=True):
        out[owner] += ids[part]
    return out


def _simple(text: str, known: Pieces) -> bool:
    """Whether single precision is exact on every path that can be the best."""
    if text == BLANK:
        return True
    body = text[1:] if text.startswith(BLANK) else text
    return len(text) <= LONG_UNIT and known.plain.issuperset(body) and (body is text or text[:2] in known.ids)


def _encoded(texts: pa.Array, known: Pieces) -> pa.ListArray:
    """Ids of each text that starts with its leading blank."""
    plain = pc.replace_substring(texts.fill_null(""), BLANK, " ")
    cut = units(plain, only_blank=True, alone=known.alone)
    ids = _remembered(cut.distinct, known)
    sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
    flat = np.frombuffer(b"".join(ids), np.int32)
    begin = np.cumsum(sizes) - sizes
    each = sizes[cut.which]
    total = np.cumsum(each)
    at = np.arange(int(each.sum())) + np.repeat(begin[cut.which] - (total - each), each)
    ends = np.concatenate(([0], total))[np.concatenate(([0], np.cumsum(cut.counts)))]
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat[at], pa.int32()))


def _remembered(blank_units: list[str], known: Pieces) -> list[bytes]:
    """Ids of units, as bytes of int32; what a worker remembers of them is bounded in bytes."""
    if known.remembered > REMEMBERED:
        known.memory.clear()
        known.remembered = 0
    found = known.memory
    new = [u for u in blank_units if u not in found]
    made = [array("i", ids).tobytes() for ids in best_ids([u.replace(" ", BLANK) for u in new], known)]
    fresh = dict(zip(new, made, strict=True))
    out = [found[u] if u in found else fresh[u] for u in blank_units]
    size = sum(len(u) + len(ids) + _ENTRY for u, ids in fresh.items())
    if known.remembered + size <= 2 * REMEMBERED:  # never one huge text
        found.update(fresh)
        known.remembered += size
    return out


def _prefixed(texts: pa.Array) -> pa.Array:
    texts = texts.fill_null("")
    return pc.if_else(pc.equal(texts, ""), texts, pc.binary_join_element_wise(" ", texts, ""))


def chunk_matrix(text: str, size: int, known: Pieces) -> np.ndarray:
    """Best scores from each entering to each leaving state of a chunk.

    ``text`` is the chunk's ``size`` characters and as many of what follows as a piece can
    reach. Beyond the first cut all paths meet, and the rest is computed once for all states.
    """
    states = known.longest
    out = np.full((states, states), _NEVER)
    inner = cuts(text, known)
    inner = inner[inner <= size]
    leave = min(states, len(text) - size + 1)
    if not len(inner) or inner[0] == size:
        for i in range(min(states, size + 1)):
            out[i, :leave] = forward(text, size, known, i)[0][size : size + leave]
        return out
    first, last = int(inner[0]), int(inner[-1] if inner[-1] < size else inner[-2] if len(inner) > 1 else inner[0])
    middle = _path_score(best_ids([text[first:last]], known)[0], known) if last > first else 0.0
    tail = forward(text[last:], size - last, known)[0][size - last : size - last + leave]
    for i in range(min(states, first + 1)):
        head = forward(text[:first], first, known, i)[0][first]
        out[i, :leave] = head + middle + tail
    return out


def _path_score(ids: list[int], known: Pieces) -> float:
    """Score of a path; the bytes of an unknown character share that character's score."""
    by_id = _scores_by_id(id(known), known)
    total = 0.0
    for i in ids:
        byte = known.bytes_of[i][0] if i in by_id[1] else None
        if byte is None:
            total += by_id[0].get(i, known.unknown_score)
        elif byte < 0x80 or byte >= 0xC0:  # the first byte of a character
            total += known.unknown_score
    return total


@functools.lru_cache(maxsize=2)
def _scores_by_id(_: int, known: Pieces) -> tuple[dict[int, float], frozenset[int]]:
    return {known.ids[t]: s for t, s in known.scores.items()}, frozenset(known.byte_ids.values())


Pieces.__hash__ = lambda self: id(self)  # for the cache


def chunk_ids(text: str, size: int, enter: int, leave: int, known: Pieces) -> list[int]:
    """Ids of the pieces that start in a chunk, given its entering and leaving state."""
    end = size + leave
    if enter >= end:
        return []
    inner = cuts(text[:end], known)
    inner = inner[(inner >= enter) & (inner <= size)]
    first = int(inner[0]) if len(inner) else None
    last = int(inner[-1]) if len(inner) else None
    if first is None:
        return _trace(text, forward(text[:end], size, known, enter)[1], end, enter, known)
    out = _trace(text, forward(text[:first], first, known, enter)[1], first, enter, known)
    out += best_ids([text[first:last]], known)[0] if last > first else []
    if last < end:
        out += _trace(text[last:end], forward(text[last:end], size - last, known)[1], end - last, 0, known)
    return out


def combine(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Max-plus product of matrices, of whole stacks at once."""
    return (one[..., :, :, None] + two[..., None, :, :]).max(axis=-2)


def scan(matrices: np.ndarray) -> np.ndarray:
    """Products of the first 1, 2, ... matrices, in rounds of doubled reach."""
    out, reach = matrices.copy(), 1
    while reach < len(out):
        out[reach:] = combine(out[:-reach], out[reach:])
        reach *= 2
    return out


def entering_scores(matrices: np.ndarray) -> np.ndarray:
    """Best score of each state before each chunk."""
    first = np.full((1, matrices.shape[1]), _NEVER)
    first[0, 0] = 0.0
    return np.concatenate((first, scan(matrices)[:-1, 0, :]))


def entered(text: str, size: int, entries: np.ndarray, known: Pieces) -> np.ndarray:
    """For each leaving state of a chunk, the entering state of the path to it: of paths with equal
    scores the one that a text segmented as a whole would take. -1 where there is none.
    """
    inner = cuts(text, known)
    inner = inner[inner <= size]
    ends = np.arange(size, size + known.longest)
    if len(inner):  # all paths meet there
        ends, size = inner[:1], min(size, int(inner[0]))
    best, start = forward(text[: int(ends[-1])], size, known, 0, entries)
    out = []
    for end in ends.tolist():
        if end >= len(best) or best[end] == _NEVER:
            out.append(-1)
            continue
        while start[end] >= 0:
            end = start[end]
        out.append(end)
    return np.array(out * (known.longest if len(inner) else 1))


def boundary_states(maps: list[np.ndarray]) -> list[int]:
    """States before, between and after chunks on the path to state 0 after the last."""
    states = [0]
    for entering in reversed(maps):
        states.append(int(entering[states[-1]]))
    return states[::-1]


def _chunked(giants: DataFrame, chunk: int, longest: int) -> DataFrame:
    """Rows (key, k, n, size, text) for each chunk of each text, with what follows it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SMALL_SLICE):
            for key, text in zip(batch.column("key").to_pylist(), batch.column("text").to_pylist(), strict=True):
                text = " " + text.replace(BLANK, " ")
                text = text.replace(" ", BLANK)
                starts = range(0, len(text), chunk)
                for k, at in enumerate(starts):
                    size = min(chunk, len(text) - at)
                    yield pa.RecordBatch.from_pydict(
                        {"key": [key], "k": [k], "size": [size], "text": [text[at : at + chunk + longest - 1]]},
                        schema=pa.schema([("key", pa.int64()), ("k", pa.int64()), ("size", pa.int64()), ("text", pa.string())]),
                    )

    return giants.select("key", "text").mapInArrow(run, "key long, k long, size long, text string")


def _giant_ids(giants: DataFrame, shared, chunk: int, longest: int) -> DataFrame:
    """(key, ids, n_chunks) of texts that are split."""
    chunks = stage(_chunked(giants, chunk, longest).repartition("key", "k"), "chunks")

    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pieces(shared.value)
        for batch in slices(batches, "text", SMALL_SLICE):
            rows = zip(batch.column("text").to_pylist(), batch.column("size").to_pylist(), strict=True)
            made = [chunk_matrix(t, n, known).astype("<f8").tobytes() for t, n in rows]
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("k"), pa.array(made, pa.binary())], ["key", "k", "matrix"])

    def scores(group: pd.DataFrame) -> pd.DataFrame:
        # a text is one value of at most 2^31 bytes, so that its matrices are bounded
        group = group.sort_values("k")
        stack = np.stack([np.frombuffer(m, "<f8").reshape(longest, longest) for m in group["matrix"]])
        found = [row.tobytes() for row in entering_scores(stack)]
        return pd.DataFrame({"key": group["key"], "k": group["k"], "entries": found})

    def maps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pieces(shared.value)
        for batch in slices(batches, "text", SMALL_SLICE):
            columns = [batch.column(c).to_pylist() for c in ("text", "size", "entries")]
            made = [entered(t, n, np.frombuffer(e, "<f8"), known).tolist() for t, n, e in zip(*columns, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("k"), pa.array(made, pa.list_(pa.int32()))], ["key", "k", "entered"]
            )

    def states(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("k")
        found = boundary_states(group["entered"].tolist())
        return pd.DataFrame({"key": group["key"], "k": group["k"], "enter": found[:-1], "leave": found[1:]})

    def trace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pieces(shared.value)
        for batch in slices(batches, "text", SMALL_SLICE):
            columns = [batch.column(c).to_pylist() for c in ("text", "size", "enter", "leave")]
            ids = [chunk_ids(*row, known) for row in zip(*columns, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("k"), pa.array(ids, pa.list_(pa.int32()))], ["key", "k", "ids"]
            )

    made = chunks.select("key", "k", "size", "text").mapInArrow(matrices, "key long, k long, matrix binary")
    scored = made.groupBy("key").applyInPandas(scores, "key long, k long, entries binary")
    entering = chunks.join(scored, ["key", "k"]).select("key", "k", "text", "size", "entries")
    mapped = entering.mapInArrow(maps, "key long, k long, entered array<int>")
    between = mapped.groupBy("key").applyInPandas(states, "key long, k long, enter long, leave long")
    traced = chunks.join(between, ["key", "k"]).select("key", "k", "text", "size", "enter", "leave")
    parts = traced.mapInArrow(trace, "key long, k long, ids array<int>")
    gathered = parts.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("k", "ids"))).alias("parts"))
    return gathered.select("key", F.flatten("parts.ids").alias("ids"), F.size("parts").cast("long").alias("n_chunks"))


def encode(docs: DataFrame, model_path: str, id: str = "doc_id", text: str = "text", chunk: int = CHUNK) -> DataFrame:
    """One row per row of ``docs``: doc_id, text, ids (array of int), n_chunks.

    A leading blank is put before texts that are not empty, blanks become the vocabulary's blank
    character (which a text's own such characters equal), and unknown characters become the
    pieces of their bytes. Null and empty texts have no ids (and 0 chunks); null ids stay null;
    repeated rows get repeated rows. At equal scores the longest last piece wins, in split texts
    too: ids do not depend on ``chunk``. Model types other than the best-scoring one are read as if they were.
    """
    with open(model_path, "rb") as file:
        model = file.read()
    if chunk < pieces(model).longest:
        raise ValueError("chunks must be as long as the longest piece")
    shared = docs.sparkSession.sparkContext.broadcast(model)
    longest = pieces(model).longest
    plain = docs.select(F.col(id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    giant = F.coalesce(F.char_length("text"), F.lit(0)) >= chunk
    kind = docs.schema[id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pieces(shared.value)
        for batch in slices(batches, "text", SMALL_SLICE):
            ids = _encoded(_prefixed(batch.column("text")), known)
            n = pc.cast(pc.greater(pc.list_value_length(ids), 0), pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, ids, n], ["doc_id", "text", "ids", "n_chunks"])

    whole = plain.where(~giant).mapInArrow(run, f"doc_id {kind}, text string, ids array<int>, n_chunks long")
    giants = stage(plain.where(giant).withColumn("key", F.monotonically_increasing_id()), "giants")
    split = giants.join(_giant_ids(giants, shared, chunk, longest), "key").select("doc_id", "text", "ids", "n_chunks")
    return whole.unionByName(split)


def decode(encoded: DataFrame, model_path: str, ids: str = "ids", to: str = "decoded") -> DataFrame:
    """``encoded`` and the text ``to`` of its ``ids``: pieces joined, leading blank dropped.

    Ids outside the vocabulary count as nothing; null or empty ids give an empty text; bytes
    that are no UTF-8 give replacement characters. A column ``to`` is replaced.
    """
    with open(model_path, "rb") as file:
        shared = encoded.sparkSession.sparkContext.broadcast(file.read())
    kept = encoded.drop(to)
    names = [*kept.columns, to]
    schema = T.StructType([*kept.schema.fields, T.StructField(to, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = byte_table(shared.value)
        for batch in batches:
            lists = batch.column(ids)
            lists = lists.fill_null([]) if lists.null_count else lists
            total = np.concatenate(([0], np.cumsum(pc.list_value_length(lists).to_numpy())))
            first = 0
            while first < batch.num_rows:
                last = max(int(np.searchsorted(total, total[first] + IDS, side="right")) - 1, first + 1)
                some = batch.slice(first, last - first)
                texts = [joined_bytes(one, table) for one in lists.slice(first, last - first)]
                decoded = [raw.decode("utf-8", "replace").removeprefix(" ") for raw in texts]
                yield pa.RecordBatch.from_arrays([*some.columns, pa.array(decoded, pa.string())], names)
                first = last

    return kept.mapInArrow(run, schema)


@functools.lru_cache(maxsize=2)
def byte_table(model: bytes) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The bytes of all pieces by id, nothing after the last; where each begins, and its length."""
    of = _piece_bytes(model)
    sizes = np.array([*map(len, of), 0])
    return b"".join(of), np.cumsum(sizes) - sizes, sizes


def _piece_bytes(model: bytes) -> list[bytes]:
    spec = sentencepiece_model_pb2.ModelProto()
    spec.ParseFromString(model)
    return [bytes_of_piece(piece) for piece in spec.pieces]


def bytes_of_piece(piece) -> bytes:
    if piece.type == piece.NORMAL:
        return piece.piece.replace(BLANK, " ").encode()
    if piece.type == piece.BYTE:
        return bytes([int(piece.piece[3:5], 16)])
    return " ⁇ ".encode() if piece.type == piece.UNKNOWN else b""


def joined_bytes(one: pa.Scalar, table: tuple[bytes, np.ndarray, np.ndarray]) -> bytes:
    """The bytes of a list of ids, a bounded number of them at a time."""
    data, begin, sizes = table
    raw = np.frombuffer(data, np.uint8)
    flat = one.values.fill_null(-1).to_numpy()
    parts = []
    for first in range(0, len(flat), IDS):
        some = flat[first : first + IDS]
        some = np.where((some < 0) | (some >= len(sizes) - 1), len(sizes) - 1, some)
        each = sizes[some]
        total = np.cumsum(each)
        parts.append(raw[np.arange(int(total[-1])) + np.repeat(begin[some] - (total - each), each)].tobytes())
    return b"".join(parts)
