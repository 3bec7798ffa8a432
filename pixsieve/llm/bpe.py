"""Byte-level BPE, encoding and decoding, over whole texts.

Pre-tokenisation runs without regular expressions on many texts at once. Every code point gets
a class; each class stands for a transition function of a small automaton over "what the
current piece is". Functions compose associatively, so the state before every code point is a
prefix scan of compositions: inside blocks for all blocks side by side, then over the block
totals. A piece starts where state and class say so.

The slices feed pair merging. Merged pieces are cached per Python worker (bounded); the missing
pieces of a chunk are merged together, one merge of every piece per step, in NumPy. Very long
pieces (an unbroken run of letters) use a heap instead. Decoding gathers the bytes of all ids by
their retained offsets.

The result equals that of the library which owns the vocabulary, one piece at a time.

Edge cases: a null or empty text has no ids and decodes to empty bytes; repeated rows are
encoded alike; an empty table gives an empty table; other columns pass through, and one that has the
name of an output column is replaced.
"""

from __future__ import annotations

import base64
import heapq
import json
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pixsieve.llm.chunks import text_chunks
from pixsieve.models import cached

# Classes of code points, with what follows already looked at.
LETTER, NUMBER, OTHER, APOSTROPHE_1, APOSTROPHE_2, SPACE, LAST_BLANK, LAST_SPACE = range(8)
# States: nothing open, run of letters, numbers, others or white space, a blank that the next
# run takes in, one or two letters of a contraction still to come.
OPEN, IN_LETTERS, IN_NUMBERS, IN_OTHERS, IN_SPACE, BLANK, ONE_MORE, TWO_MORE = range(8)
CACHE_PIECES = 300_000
LONG_PIECE = 128
WIDTHS = (0, 4, 6, 8, 10, 12, 16, 24, 32, 64, LONG_PIECE)
PLACE_BITS = 7
DECODE_BYTES = 1 << 20
NO_RANK = np.uint32(0xFFFFFFFF)


def _step(state: int, kind: int) -> tuple[int, bool]:
    """The state after a code point, and whether a piece starts at it."""
    if state in (ONE_MORE, TWO_MORE):
        return (OPEN if state == ONE_MORE else ONE_MORE), False
    if kind in (LETTER, NUMBER, OTHER):
        run = {LETTER: IN_LETTERS, NUMBER: IN_NUMBERS, OTHER: IN_OTHERS}[kind]
        return run, state not in (run, BLANK)
    if kind in (APOSTROPHE_1, APOSTROPHE_2):
        if state in (IN_OTHERS, BLANK):
            return IN_OTHERS, False
        return (ONE_MORE if kind == APOSTROPHE_1 else TWO_MORE), True
    if kind == SPACE:
        return IN_SPACE, state != IN_SPACE
    return (BLANK if kind == LAST_BLANK else OPEN), True


@cached
def _automaton() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(function of each class, and of each class at the start of a text; compositions;
    value of a function at OPEN; starts by state and class)."""
    plain = [tuple(_step(s, k)[0] for s in range(8)) for k in range(8)]
    reset = [(_step(OPEN, k)[0],) * 8 for k in range(8)]
    found = {f: i for i, f in enumerate(dict.fromkeys(plain + reset))}
    grown = True
    while grown:
        grown = False
        for first in list(found):
            for then in plain + reset:
                both = tuple(then[s] for s in first)
                if both not in found:
                    found[both] = len(found)
                    grown = True
    compose = np.zeros((len(found), len(found)), np.uint16)
    for first, i in found.items():
        for then, j in found.items():
            compose[i, j] = found[tuple(then[s] for s in first)]
    codes = np.array([found[f] for f in plain + reset], np.uint16)
    at_open = np.array([f[OPEN] for f in found], np.uint8)
    starts = np.array([[_step(s, k)[1] for k in range(8)] for s in range(8)])
    return codes, compose, at_open, starts


def _scan(functions: np.ndarray, compose: np.ndarray) -> np.ndarray:
    """Compositions of all prefixes: of each block's own prefixes, and of the blocks before."""
    n = len(functions)
    if n <= 64:
        out = functions.copy()
        for i in range(1, n):
            out[i] = compose[out[i - 1], out[i]]
        return out
    width = 64
    blocks = -(-n // width)
    padded = np.zeros(blocks * width, np.uint16)
    padded[:n] = functions
    lanes = np.ascontiguousarray(padded.reshape(blocks, width).T)
    size, flat = compose.shape[0], compose.ravel()
    for i in range(1, width):
        lanes[i] = flat[lanes[i - 1].astype(np.int32) * size + lanes[i]]
    before = _scan(lanes[-1], compose)[:-1].astype(np.int32) * size
    lanes[:, 1:] = flat[before[None, :] + lanes[:, 1:]]
    return np.ascontiguousarray(lanes.T).ravel()[:n]


def piece_starts(texts: list[str], kinds: np.ndarray) -> tuple[str, np.ndarray, np.ndarray]:
    """All texts joined, where pieces start in it, and where texts start in it.

    ``kinds`` holds LETTER, NUMBER, OTHER or SPACE for every code point.
    """
    joined = "".join(texts)
    begins = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) for t in texts], out=begins[1:])
    if not joined:
        return joined, np.zeros(0, np.int64), begins
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    n = len(points)
    own = kinds[points]
    first = np.zeros(n + 1, bool)
    first[begins] = True
    last = first[1:]
    nonspace = np.zeros(n + 1, bool)
    nonspace[:-1] = own != SPACE
    final = (own == SPACE) & nonspace[1:] & ~last
    blank = points == 0x20
    own = own.copy()
    own[final & blank] = LAST_BLANK
    own[final & ~blank] = LAST_SPACE
    quotes = np.flatnonzero(points == 0x27)
    if len(quotes):
        tail = np.zeros((2, len(quotes)), np.uint32)
        for k in range(2):
            at = np.minimum(quotes + k + 1, n - 1)
            inside = (quotes + k + 1 < n) & ~first[at]
            tail[k] = np.where(inside & ((k == 0) | (tail[0] > 0)), points[at], 0)
        one = np.isin(tail[0], [ord(c) for c in "stmd"])
        two = np.isin(tail[0] * np.uint32(1 << 16) + np.minimum(tail[1], 0xFFFF), [(ord(a) << 16) + ord(b) for a, b in ("re", "ve", "ll")])
        own[quotes[one]] = APOSTROPHE_1
        own[quotes[two]] = APOSTROPHE_2
    codes, compose, at_open, starts = _automaton()
    functions = codes[own]
    heads = begins[:-1][begins[:-1] < begins[1:]]
    functions[heads] = codes[own[heads] + 8]
    after = at_open[_scan(functions, compose)]
    before = np.empty_like(after)
    before[0] = OPEN
    before[1:] = after[:-1]
    before[heads] = OPEN
    return joined, np.flatnonzero(starts.ravel()[before * np.uint8(8) + own]), begins


class PairTable:
    """(left id, right id) to (rank, merged id), in an open-addressed array."""

    def __init__(self, left: np.ndarray, right: np.ndarray, rank: np.ndarray, merged: np.ndarray) -> None:
        keys = (left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64)
        bits = max(4, int(len(keys) * 4).bit_length())
        self._shift, self._mask = np.uint64(64 - bits), (1 << bits) - 1
        self._keys = np.full(1 << bits, np.uint64(0xFFFFFFFFFFFFFFFF))
        self._rank = np.full(1 << bits, NO_RANK)
        self._merged = np.zeros(1 << bits, np.int32)
        todo, slot = np.arange(len(keys)), self._slot(keys)
        while len(todo):
            free = self._rank[slot] == NO_RANK
            taken, who = np.unique(slot[free], return_index=True)
            now = todo[free][who]
            self._keys[taken], self._rank[taken], self._merged[taken] = keys[now], rank[now], merged[now]
            left_over = ~np.isin(todo, now)
            todo, slot = todo[left_over], (slot[left_over] + 1) & self._mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> self._shift).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keys = (left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64)
        slot = self._slot(keys)
        seen = self._keys[slot]
        todo = np.flatnonzero((seen != keys) & (self._rank[slot] != NO_RANK))
        while len(todo):
            slot[todo] = (slot[todo] + 1) & self._mask
            at = slot[todo]
            todo = todo[(self._keys[at] != keys[todo]) & (self._rank[at] != NO_RANK)]
        return self._rank[slot], self._merged[slot]


class Coder:
    """Encodes and decodes with one vocabulary; holds the cache of merged pieces."""

    def __init__(self, vocabulary: dict[bytes, int], pairs: PairTable, kinds: np.ndarray, whole: bool, special: dict[str, int]) -> None:
        self._vocabulary, self._pairs, self._kinds, self._whole = vocabulary, pairs, kinds, whole
        self._special = special
        self._cut = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True)))) if special else None
        self._byte_ids = np.array([vocabulary[bytes([b])] for b in range(256)], np.int32)
        self._cache: dict[str, bytes] = {}
        spans = {i: b for b, i in vocabulary.items()} | {i: s.encode() for s, i in special.items()}
        size = max(spans) + 1
        lengths = np.zeros(size, np.int64)
        for i, b in spans.items():
            lengths[i] = len(b)
        self._lengths = lengths
        self._offsets = np.concatenate(([0], np.cumsum(lengths)))
        self._flat = np.frombuffer(b"".join(spans.get(i, b"") for i in range(size)), np.uint8)

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        if self._cut is None or not any(self._cut.search(t) for t in texts):
            return self._encode_plain(texts)
        parts = [self._cut.split(t) for t in texts]
        inner = iter(self._encode_plain([p for own in parts for p in own]))
        out = []
        for text, own in zip(texts, parts, strict=True):
            marks = [np.uint32(self._special[m]).tobytes() for m in self._cut.findall(text)]
            pieces = [next(inner) for _ in own]
            out.append(b"".join(x for pair in zip(pieces, [*marks, b""], strict=True) for x in pair))
        return out

    def _encode_plain(self, texts: list[str]) -> list[bytes]:
        joined, starts, begins = piece_starts(texts, self._kinds)
        at = starts.tolist()
        pieces = [joined[a:b] for a, b in zip(at, [*at[1:], len(joined)], strict=True)] if at else []
        missing = set(pieces).difference(self._cache)
        if len(missing) + len(self._cache) > CACHE_PIECES:
            self._cache.clear()
            missing = set(pieces)
        self._merge_all(list(missing))
        edges = np.searchsorted(starts, begins).tolist()
        get = self._cache.__getitem__
        return [b"".join(map(get, pieces[a:b])) for a, b in zip(edges, edges[1:], strict=False)]

    def decode(self, ids: list[bytes]) -> list[bytes]:
        """The bytes of each list of ids."""
        tokens = np.frombuffer(b"".join(ids), "<u4").astype(np.int64)
        lengths = self._lengths[tokens]
        ends = np.cumsum(lengths)
        shift = np.repeat(self._offsets[tokens] - (ends - lengths), lengths)
        data = self._flat[shift + np.arange(len(shift))].tobytes()
        marks = np.concatenate(([0], ends))[np.cumsum([0, *[len(x) // 4 for x in ids]])].tolist()
        return [data[a:b] for a, b in zip(marks, marks[1:], strict=False)]

    def token_offsets(self, ids: bytes) -> np.ndarray:
        """Where each token's bytes start, and last the number of bytes."""
        return np.concatenate(([0], np.cumsum(self._lengths[np.frombuffer(ids, "<u4")])))

    def _merge_all(self, pieces: list[str]) -> None:
        """Puts the ids of all pieces into the cache."""
        raws = [p.encode("utf-8", "surrogatepass") for p in pieces]
        sizes = np.fromiter(map(len, raws), np.int64, len(raws))
        whole = np.array([r in self._vocabulary for r in raws], bool) if self._whole else sizes == 1
        for i in np.flatnonzero(whole).tolist():
            self._cache[pieces[i]] = self._vocabulary[raws[i]].to_bytes(4, "little")
        for i in np.flatnonzero(~whole & (sizes > LONG_PIECE)).tolist():
            self._cache[pieces[i]] = self._merge_long(raws[i])
        for narrower, width in zip(WIDTHS, WIDTHS[1:], strict=False):
            own = np.flatnonzero(~whole & (sizes > narrower) & (sizes <= width)).tolist()
            for k in range(0, len(own), 1 << 13):
                part = own[k:k + (1 << 13)]
                self._cache.update(zip([pieces[i] for i in part], self._merge_block([raws[i] for i in part], width), strict=True))

    def _merge_block(self, raws: list[bytes], width: int) -> list[bytes]:
        """Merges of all pieces side by side: one merge of every open piece per step.

        Pieces are columns. What may be merged next at a place is its rank with the place in the
        low bits, so the least entry of a column names the next merge and where it is.
        """
        n = len(raws)
        lengths = np.array([len(r) for r in raws])
        data = np.frombuffer(b"".join(r.ljust(width, b"\0") for r in raws), np.uint8).reshape(n, width).T
        places = np.arange(width)[:, None]
        ids = np.where(places < lengths, self._byte_ids[data], -1).astype(np.int32)
        entry = np.full((width, n), NO_RANK)
        merged = np.zeros((width, n), np.int32)

        def offer(at: np.ndarray, then: np.ndarray, column: np.ndarray) -> None:
            rank, new = self._pairs.find(ids[at, column], ids[then, column])
            entry[at, column] = np.where(rank == NO_RANK, NO_RANK, (rank << PLACE_BITS) | at.astype(np.uint32))
            merged[at, column] = new

        at, column = np.nonzero(places < lengths - 1)
        offer(at, at + 1, column)
        following = np.broadcast_to(places + 1, (width, n)).astype(np.int16)
        following[lengths - 1, np.arange(n)] = width
        previous = np.broadcast_to(places - 1, (width, n)).astype(np.int16)
        columns = np.arange(n)
        while True:
            least = (entry if len(columns) == n else np.take(entry, columns, axis=1)).min(axis=0)
            open_ = least != NO_RANK
            columns, at = columns[open_], (least[open_] & np.uint32((1 << PLACE_BITS) - 1)).astype(np.int64)
            if not len(columns):
                break
            gone = following[at, columns]
            after = following[gone, columns]
            ids[at, columns] = merged[at, columns]
            ids[gone, columns] = -1
            entry[gone, columns] = NO_RANK
            entry[at, columns] = NO_RANK
            following[at, columns] = after
            right = np.flatnonzero(after < width)
            previous[after[right], columns[right]] = at[right]
            before = previous[at, columns]
            left = np.flatnonzero(before >= 0)
            offer(np.concatenate((at[right], before[left])), np.concatenate((after[right], at[left])), np.concatenate((columns[right], columns[left])))
        ids = ids.T
        kept = ids >= 0
        flat = ids[kept].astype("<u4").tobytes()
        ends = (4 * np.cumsum(kept.sum(axis=1))).tolist()
        return [flat[a:b] for a, b in zip([0, *ends], ends, strict=False)]

    def _merge_long(self, raw: bytes) -> bytes:
        """The same merges for one long piece, next merge from a heap."""
        ids = self._byte_ids[np.frombuffer(raw, np.uint8)]
        rank, merged = self._pairs.find(ids[:-1], ids[1:])
        ids, n = ids.tolist(), len(raw)
        following, previous = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(int(rank[i]), i, ids[i], ids[i + 1], int(merged[i])) for i in np.flatnonzero(rank != NO_RANK)]
        heapq.heapify(heap)

        def offer(i: int, j: int) -> None:
            r, m = self._pairs.find(np.array([ids[i]]), np.array([ids[j]]))
            if r[0] != NO_RANK:
                heapq.heappush(heap, (int(r[0]), i, ids[i], ids[j], int(m[0])))

        while heap:
            _, i, a, b, new = heapq.heappop(heap)
            j = following[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j], following[i] = new, -1, following[j]
            if following[i] < n:
                previous[following[i]] = i
                offer(i, following[i])
            if previous[i] >= 0:
                offer(previous[i], i)
        return np.array([x for x in ids if x >= 0], "<u4").tobytes()


def _all_points() -> str:
    """Every code point that can be a letter, number or white space; planes above have none."""
    return "".join(chr(c) for c in range(0x40000) if not 0xD800 <= c < 0xE000)


def _kinds(letters: Iterable[str], numbers: Iterable[str], spaces: Iterable[str]) -> np.ndarray:
    kinds = np.full(0x110000, OTHER, np.uint8)
    for members, kind in ((letters, LETTER), (numbers, NUMBER), (spaces, SPACE)):
        kinds[np.frombuffer("".join(members).encode("utf-32-le"), np.uint32)] = kind
    return kinds


@cached
def rank_file_coder(path: str) -> Coder:
    """A coder for a file of lines "base64 token, rank"; one per worker process.

    What counts as letter, number and white space is asked of the library once.
    """
    import tiktoken

    with open(path, "rb") as lines:
        vocabulary = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    parts = [(vocabulary[t[:k]], vocabulary[t[k:]], i) for t, i in vocabulary.items() for k in range(1, len(t)) if t[:k] in vocabulary and t[k:] in vocabulary]
    left, right, merged = np.array(parts, np.int64).T
    single = {bytes([b]): b for b in range(256)}

    def matched(pattern: str) -> str:
        probe = tiktoken.Encoding("probe", pat_str=pattern, mergeable_ranks=single, special_tokens={})
        return probe.decode(probe.encode_ordinary(_all_points()))

    kinds = _kinds(matched(r"\p{L}"), matched(r"\p{N}"), matched(r"\s"))
    return Coder(vocabulary, PairTable(left, right, merged.astype(np.uint32), merged.astype(np.int32)), kinds, True, {})


@cached
def tokenizer_file_coder(path: str) -> Coder:
    """A coder for a byte-level BPE ``tokenizer.json``; one per worker process.

    Added tokens stand for themselves wherever their string occurs in a text.
    """
    from tokenizers import Regex, pre_tokenizers

    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}

    def raw(token: str) -> bytes:
        return bytes(letters[c] for c in token)

    vocab = spec["model"]["vocab"]
    special = {x["content"]: x["id"] for x in spec["added_tokens"]}
    merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
    left = np.array([vocab[a] for a, _ in merges])
    right = np.array([vocab[b] for _, b in merges])
    merged = np.array([vocab[a + b] for a, b in merges], np.int32)

    def matched(pattern: str) -> Iterator[str]:
        split = pre_tokenizers.Split(Regex(pattern), behavior="removed", invert=True)
        return (part for part, _ in split.pre_tokenize_str(_all_points()))

    kinds = _kinds(matched(r"\p{L}+"), matched(r"\p{N}+"), matched(r"\s+"))
    vocabulary = {raw(t): i for t, i in vocab.items() if t not in special}
    pairs = PairTable(left, right, np.arange(len(merges), dtype=np.uint32), merged)
    return Coder(vocabulary, pairs, kinds, bool(spec["model"].get("ignore_merges")), special)


def coder_of(path: str) -> Coder:
    return tokenizer_file_coder(path) if path.endswith(".json") else rank_file_coder(path)


def encode(docs: DataFrame, path: str, text: str = "text", offsets: bool = False) -> DataFrame:
    """Adds ``n_tokens`` and ``ids`` (binary, little-endian unsigned 32-bit integers).

    ``path`` is a vocabulary file that all executors can open. With ``offsets``, also adds
    ``token_offsets``: where each token's bytes start, and last the number of bytes. The text column
    itself is not returned; join or decode if it is needed.
    """
    kept = docs.drop("n_tokens", "ids", "token_offsets")
    rest = [f for f in kept.schema if f.name != text]
    added = [T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType())]
    if offsets:
        added.append(T.StructField("token_offsets", T.ArrayType(T.LongType())))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = coder_of(path)
        for rows, texts in text_chunks(batches, text):
            ids = coder.encode(texts)
            columns = [rows.column(f.name) for f in rest]
            columns += [pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())]
            if offsets:
                columns.append(pa.array([coder.token_offsets(x) for x in ids], pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in [*rest, *added]])

    return kept.mapInArrow(run, T.StructType([*rest, *added]))


def decode(encoded: DataFrame, path: str, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """Adds ``into`` (binary), the bytes that ``ids`` stand for (null: empty)."""
    kept = encoded.drop(into)
    schema = T.StructType([*kept.schema.fields, T.StructField(into, T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = coder_of(path)
        for batch in batches:
            known = [x or b"" for x in batch.column(ids).to_pylist()]
            start = size = 0
            for i, own in enumerate(known):
                size += len(own)
                if size >= DECODE_BYTES or i == len(known) - 1:
                    part = batch.slice(start, i + 1 - start)
                    decoded = pa.array(coder.decode(known[start:i + 1]), pa.binary())
                    yield pa.RecordBatch.from_arrays([*part.columns, decoded], names=schema.names)
                    start, size = i + 1, 0

    return kept.mapInArrow(run, schema)


def digests(docs: DataFrame, path: str) -> DataFrame:
    """Per document: number of ids, and the hashes of its ids and of what they decode to."""
    coded = decode(encode(docs.select("doc_id", "text"), path), path)
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
