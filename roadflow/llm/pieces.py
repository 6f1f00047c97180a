"""SentencePiece encoding and decoding (byte-pair models) by suffix-array matching of the pieces."""

from __future__ import annotations

import functools
import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import fresh, of_texts, without
from .textvec import U, _power, mix

SPACE = 0x2581
#: Characters of text that are indexed together; segments longer than LONG are merged by a heap.
BATCH, LONG = 500_000, 160
NONE = np.int32(2**31 - 1)


class Vocabulary:
    """Pieces of a model file: their characters, ids and bytes."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        sp = SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        self.bytes: list[bytes] = []
        self.byte_id = np.full(256, sp.unk_id(), np.int32)
        words: list[tuple[float, int, str]] = []
        for i in range(n):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte_id[int(piece[3:5], 16)] = i
                self.bytes.append(bytes([int(piece[3:5], 16)]))
            elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                self.bytes.append(b"")
            else:
                self.bytes.append(piece.replace("▁", " ").encode())
                words.append((-sp.get_score(i), i, piece))
        words.sort()
        self.crossing = any("▁" in p.lstrip("▁") for _, _, p in words)
        self.char_id = {ord(p): i for _, i, p in words if len(p) == 1}
        longer = [(i, p) for _, i, p in words if len(p) > 1]
        self.ids = np.array([i for i, _ in longer], np.int32)  # by priority
        self.size = np.array([len(p) for _, p in longer], np.int64)
        self.longest = int(self.size.max()) if len(longer) else 1
        self.chars = np.zeros((len(longer), self.longest), np.uint32)
        for k, (_, p) in enumerate(longer):
            self.chars[k, : len(p)] = [ord(c) for c in p]
        self.known = np.unique(self.chars[self.chars > 0])

    def decode(self, ids: np.ndarray) -> str:
        table = self.bytes
        text = b"".join([table[i] for i in ids.tolist()]).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


@functools.lru_cache(maxsize=1)
def vocabulary(path: str) -> Vocabulary:
    """A worker reads the model file once."""
    return Vocabulary(path)


def suffix_array(codes: np.ndarray, depth: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Order of all suffixes by their first ``depth`` codes, and those codes packed into 64-bit keys, in that order."""
    per = 8 // codes.dtype.itemsize
    bits = U(8 * codes.dtype.itemsize)
    padded = np.concatenate((codes, np.zeros(per * -(-depth // per), codes.dtype))).astype(U)
    n = len(codes)
    word = np.zeros(len(padded), U)
    for k in range(per):
        word <<= bits
        word[: len(padded) - k] |= padded[k:]
    keys = [word[k : k + n] for k in range(0, depth, per)]
    order = np.lexsort(keys[::-1])
    return order, [k[order] for k in keys]


def _search(keys: list[np.ndarray], wanted: list[np.ndarray], after: bool = False) -> np.ndarray:
    """First place in the sorted keys that isn't below each wanted key, or that is above it, all by one binary search
    side by side."""
    n, m = len(keys[0]), len(wanted[0])
    low, high = np.zeros(m, np.int64), np.full(m, n, np.int64)
    while (low < high).any():
        mid = (low + high) // 2
        at = np.minimum(mid, n - 1)
        below, tied = np.zeros(m, bool), np.ones(m, bool)
        for k, w in zip(keys, wanted, strict=True):
            v = k[at]
            below |= tied & (v < w)
            tied &= v == w
        if after:
            below |= tied
        open_ = low < high
        low = np.where(open_ & below, mid + 1, low)
        high = np.where(open_ & ~below, mid, high)
    return low


def edges(text: np.ndarray, vocab: Vocabulary) -> np.ndarray:
    """Priority (index into ``vocab.ids``) of the piece at each position and length, NONE where there is none.

    The suffixes of the text are sorted as deep as the longest piece, every piece's range of occurrences is found by
    binary search, and the resulting edges are put in order of position and length.
    """
    table = np.full((len(text), vocab.longest + 1), NONE, np.int32)
    here = np.unique(text)
    here = here[np.isin(here, vocab.known)]
    kind = np.uint8 if len(here) < 255 else np.uint16
    at = np.searchsorted(here, text)
    codes = np.where((at < len(here)) & (here[np.minimum(at, len(here) - 1)] == text), at + 1, 0).astype(kind) if len(here) else np.zeros(len(text), kind)
    if not len(here):
        return table
    order, keys = suffix_array(codes, vocab.longest)
    spot = np.searchsorted(here, vocab.chars)
    there = here[np.minimum(spot, len(here) - 1)] == vocab.chars
    pad = vocab.chars == 0
    usable = np.flatnonzero((there | pad).all(axis=1))
    if not len(usable):
        return table
    spelled = np.where(pad[usable], 0, spot[usable] + 1).astype(U)
    beyond = np.where(pad[usable], np.iinfo(kind).max, spelled).astype(U)
    per, bits = 8 // np.dtype(kind).itemsize, U(8 * np.dtype(kind).itemsize)

    def packed(rows: np.ndarray) -> list[np.ndarray]:
        wide = np.concatenate((rows, np.full((len(rows), -rows.shape[1] % per), 0 if rows is spelled else np.iinfo(kind).max, U)), axis=1)
        out = []
        for k in range(0, wide.shape[1], per):
            key = np.zeros(len(rows), U)
            for c in range(per):
                key = (key << bits) | wide[:, k + c]
            out.append(key)
        return out

    # A piece of full depth may have no padding: then both keys are the same, and its occurrences equal them.
    first, last = _search(keys, packed(spelled)), _search(keys, packed(beyond), after=True)
    count = last - first
    which = np.repeat(np.arange(len(usable)), count)
    place = np.repeat(first - np.concatenate(([0], np.cumsum(count)[:-1])), count) + np.arange(count.sum())
    table[order[place], vocab.size[usable][which]] = usable[which]
    return table


def relax(table: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Segment, start and end of each symbol at the end of merging. In every round each segment that still has an edge
    across two neighbouring symbols follows the one of highest priority (ties: the leftmost)."""
    longest = table.shape[1] - 1
    size = ends - starts
    seg = np.repeat(np.arange(len(starts)), size)
    s = np.arange(size.sum()) + np.repeat(starts - np.concatenate(([0], np.cumsum(size)[:-1])), size)
    e = s + 1
    done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    while len(s):
        n = len(s)
        span = np.minimum(e[1:] - s[:-1], longest + 1)
        rank = np.full(n, NONE, np.int64)
        ok = (seg[1:] == seg[:-1]) & (span <= longest)
        rank[:-1][ok] = table[s[:-1][ok], span[ok]]
        head = np.flatnonzero(np.concatenate(([True], seg[1:] != seg[:-1])))
        best = np.minimum.reduceat((rank << 32) | np.arange(n), head)
        live = best >> 32 < NONE
        if not live.all():
            kept = np.repeat(live, np.diff(np.concatenate((head, [n]))))
            done.append((seg[~kept], s[~kept], e[~kept]))
        at = best[live] & 0xFFFFFFFF
        if not len(at):
            break
        e[at] = e[at + 1]
        keep = np.ones(n, bool)
        keep[at + 1] = False
        if not live.all():
            keep &= kept
        seg, s, e = seg[keep], s[keep], e[keep]
    seg, s, e = (np.concatenate([d[k] for d in done]) if done else np.zeros(0, np.int64) for k in range(3))
    by = np.argsort(s, kind="stable")
    return seg[by], s[by], e[by]


def relax_long(table: np.ndarray, start: int, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The same for one long segment, with a heap of edges."""
    n, longest = end - start, table.shape[1] - 1
    stop = list(range(1, n + 1))  # end of the symbol that starts here
    before = list(range(-1, n - 1))
    alive = [True] * n
    heap: list[tuple[int, int, int]] = []

    def offer(i: int) -> None:
        j = stop[i]
        if j < n and stop[j] - i <= longest and (r := int(table[start + i, stop[j] - i])) != NONE:
            heapq.heappush(heap, (r, i, stop[j]))

    for i in range(n):
        offer(i)
    while heap:
        _, i, to = heapq.heappop(heap)
        if not alive[i] or stop[i] >= n or not alive[stop[i]] or stop[stop[i]] != to:
            continue
        j = stop[i]
        alive[j], stop[i] = False, to
        if to < n:
            before[to] = i
        offer(i)
        if before[i] >= 0:
            offer(before[i])
    s = np.flatnonzero(alive)
    return start + s, start + np.array([stop[i] for i in s], np.int64)


def encode(texts: list[str | None], vocab: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts one after the other, and where each text's begin (one place more than texts)."""
    lengths = np.array([len(t) + 1 if t else 0 for t in texts], np.int64)
    text = np.frombuffer("".join("▁" + t for t in texts if t).encode("utf-32-le"), np.uint32).copy()
    if not len(text):
        return np.zeros(0, np.int32), np.zeros(len(texts) + 1, np.int64)
    text[text == 32] = SPACE
    offsets = np.concatenate(([0], np.cumsum(lengths)))
    begin = np.zeros(len(text) + 1, bool)
    begin[offsets] = True
    if not vocab.crossing:
        space = text == SPACE
        begin[1:-1] |= space[1:] & ~space[:-1]
    cuts = np.flatnonzero(begin)
    s, e = cuts[:-1], cuts[1:]
    p, inv = _power(len(text) + 1)
    sums = np.zeros(len(text) + 1, U)
    np.cumsum(mix(text.astype(U) + U(1)) * p[:-1], out=sums[1:])
    h = mix((sums[e] - sums[s]) * inv[s] + (e - s).astype(U))
    _, one, which = np.unique(h, return_index=True, return_inverse=True)
    # The distinct segments, one after the other, each closed by a mark that no piece has.
    size = e[one] - s[one]
    starts = np.concatenate(([0], np.cumsum(size + 1)))[:-1]
    short = np.zeros(int((size + 1).sum()), np.uint32)
    inside = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    short[np.repeat(starts, size) + inside] = text[np.repeat(s[one], size) + inside]
    short[starts + size] = 0x110000
    table = edges(short, vocab)
    long = size > LONG
    seg, a, b = relax(table, starts[~long], (starts + size)[~long])
    seg = np.flatnonzero(~long)[seg]
    if long.any():
        more = [(k, *relax_long(table, int(starts[k]), int(starts[k] + size[k]))) for k in np.flatnonzero(long)]
        seg = np.concatenate((seg, *[np.full(len(x), k) for k, x, _ in more]))
        a, b = np.concatenate((a, *[x for _, x, _ in more])), np.concatenate((b, *[y for _, _, y in more]))
        by = np.argsort(a, kind="stable")
        seg, a, b = seg[by], a[by], b[by]
    # Ids of symbols; a character without piece becomes its bytes.
    width = b - a
    many = width > 1
    ids = np.empty(len(a), np.int32)
    ids[many] = vocab.ids[table[a[many], width[many]]]
    chars, at = np.unique(short[a[~many]], return_inverse=True)
    ids[~many] = np.array([vocab.char_id.get(int(c), -1) for c in chars], np.int32)[at] if len(chars) else 0
    unknown = np.flatnonzero(ids < 0)
    if len(unknown):
        raw = [chr(int(c)).encode("utf-8") for c in short[a[unknown]]]
        count = np.ones(len(ids), np.int64)
        count[unknown] = [len(r) for r in raw]
        ids, seg = np.repeat(ids, count), np.repeat(seg, count)
        ids[ids < 0] = vocab.byte_id[np.frombuffer(b"".join(raw), np.uint8)]
    # Ids of texts: those of their segments.
    first = np.searchsorted(seg, np.arange(len(one) + 1))
    count = np.diff(first)[which]
    ends = np.cumsum(count)
    out = ids[np.arange(count.sum()) + np.repeat(first[which] - (ends - count), count)]
    total = np.concatenate(([0], ends))
    return out, total[np.searchsorted(s, offsets)]


def tokenised(docs: DataFrame, model: str, text_col: str = "text", with_ids: bool = True) -> DataFrame:
    """The documents with ``ids`` (array<int>, if asked), ``n_tokens``, ``ids_crc32`` (of the ids as little-endian
    32-bit integers) and ``decoded`` (whether decoding gives the text back; the model can't tell U+2581 from a space).

    The ids are those of the SentencePiece library for a byte-pair model whose normaliser changes nothing: spaces
    become U+2581 and one is put in front. Row by row, without a shuffle; equal segments of a block are matched once.
    Null and empty texts have no ids. Columns of the input with the names of new ones are replaced, others stay.
    ``model`` is a path that the executors can read.
    """

    def begin():
        vocab = vocabulary(model)

        def found(texts: list[str | None]) -> pd.DataFrame:
            ids, cut = encode(texts, vocab)
            parts = [ids[a:b] for a, b in zip(cut[:-1], cut[1:], strict=True)]
            return pd.DataFrame({
                **({"ids": parts} if with_ids else {}),
                "n_tokens": np.diff(cut),
                "ids_crc32": np.array([zlib.crc32(p.astype("<i4").tobytes()) for p in parts], np.int64),
                "decoded": np.array([vocab.decode(p) == (t or "").replace("▁", " ") for p, t in zip(parts, texts, strict=True)], bool),
            })

        return found

    new = [*(["ids"] if with_ids else []), "n_tokens", "ids_crc32", "decoded"]
    rest = without(docs, *[n for n in new if n != text_col])
    into = fresh(rest, "pieces")
    kind = "struct<" + "ids:array<int>," * with_ids + "n_tokens:bigint,ids_crc32:bigint,decoded:boolean>"
    return of_texts(rest, text_col, into, kind, begin, BATCH).select(*[F.col(f"`{c}`") for c in rest.columns], f"{into}.*")


def decode(tokens: DataFrame, model: str, ids_col: str = "ids") -> DataFrame:
    """The rows with ``text`` decoded from their ids (a column of that name is replaced); null ids give a null text."""

    @F.pandas_udf("string")
    def texts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        vocab = vocabulary(model)
        for ids in batches:
            yield pd.Series([None if x is None else vocab.decode(np.asarray(x)) for x in ids], dtype=object)

    return without(tokens, "text").withColumn("text", texts(F.col(f"`{ids_col}`")))


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")
