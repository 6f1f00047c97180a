"""Near-duplicate documents by HyperMinHash: compressed registers, banding, corrected estimates, then full sets."""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import batches_of, connected_components, of_texts, split_by_keys, stage, unstage
from .textvec import SPACES, U, Block, mix

#: Registers; mantissa bits beside the leading-zero count of each; registers in a band (36 bands).
REGISTERS, MANTISSA, ROWS = 256, 10, 7
BANDS = REGISTERS // ROWS
EMPTY = 0xFFFF
#: A hub's canopy holds estimates from LOOSE on, and members from CORE on are done with it: by the triangle
#: inequality 1 - LOOSE > (1 - 0.8) + (1 - CORE), with several standard errors (0.03) of slack. Pairs below PAIR are
#: not compared. Small sets fill few registers, so that their estimates scatter more.
CORE, LOOSE, PAIR = 0.76, 0.40, 0.68
SMALL, MORE_SLACK = 64, 0.15
#: Documents in a block of a large canopy, and in a pack of small ones.
BLOCK, PACK = 256, 400
#: Rounds in which hubs take their canopies out of the buckets, before the rest is compared in blocks.
HUB_ROUNDS = 2


def word_shingles(block: Block, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and 64-bit hash of each distinct shingle of ``width`` words, ordered by row and hash; a text of fewer words
    has its whole sequence as its only shingle."""
    s, e, row = block.words(SPACES)
    h = block.hashes(s, e)
    n = len(h)
    if not n:
        return row, h
    left = np.searchsorted(row, row, side="right") - np.arange(n)  # words from here to the end of the text
    head = np.concatenate(([True], row[1:] != row[:-1]))
    begins = (left >= width) | head
    at = np.flatnonzero(begins)
    out = np.full(len(at), U(0x2545F4914F6CDD1D))
    for k in range(width):
        inside = left[at] > k
        out[inside] = mix(out[inside] * U(0x9E3779B97F4A7C15) + h[at[inside] + k])
    row = row[at]
    order = np.lexsort((out, row))
    row, out = row[order], out[order]
    new = np.concatenate(([True], (row[1:] != row[:-1]) | (out[1:] != out[:-1])))
    return row[new], out[new]


_rng = np.random.default_rng(3)
_PROBES = np.argsort(_rng.random((REGISTERS, REGISTERS)), axis=1)  # a permutation of all registers for each one


def registers(row: np.ndarray, h: np.ndarray, n: int) -> np.ndarray:
    """n x REGISTERS: of each bucket's smallest hash the count of leading zeros and the mantissa bits after them. A
    bucket without hash takes over the register of the first filled one in its own fixed order of probes."""
    least = np.full(n * REGISTERS, np.iinfo(U).max, U)
    shift = U(REGISTERS.bit_length() - 1)
    np.minimum.at(least, row * REGISTERS + (h & U(REGISTERS - 1)).astype(np.int64), h >> shift)
    filled = least != np.iinfo(U).max
    parts = np.where(filled, least, U(1)).astype(np.float64).view(U)
    zeros = U(1023 + 64) - shift - (parts >> U(52))
    out = np.where(filled, (zeros << U(MANTISSA)) | ((parts >> U(52 - MANTISSA)) & U((1 << MANTISSA) - 1)), U(EMPTY)).astype(np.uint16)
    out, filled = out.reshape(n, REGISTERS), filled.reshape(n, REGISTERS)
    todo_row, todo = np.nonzero(~filled & filled.any(axis=1, keepdims=True))
    for k in range(_PROBES.shape[1]):
        if not len(todo):
            break
        source = _PROBES[todo, k]
        hit = filled[todo_row, source]
        out[todo_row[hit], todo[hit]] = out[todo_row[hit], source[hit]]
        todo_row, todo = todo_row[~hit], todo[~hit]
    return out


def jaccard(ra: np.ndarray, rb: np.ndarray, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """Share of equal registers, less the share that would be equal by chance: two independent minima fall into the
    same register with probability 2^-MANTISSA * ab / (a + b)^2 / (2 ln 2)."""
    same = (ra == rb).mean(axis=-1)
    chance = 0.7213 * 2.0**-MANTISSA * na * nb / (na + nb) ** 2
    return (same - chance) / (1 - chance)


def signatures(docs: DataFrame, width: int) -> DataFrame:
    """``doc_id, n, d1, d2, regs``: set size, 128-bit digest of the set, registers (null for an empty set)."""

    def signed(texts: list[str | None]) -> pd.DataFrame:
        n = len(texts)
        row, h = word_shingles(Block(texts), width) if n else (np.zeros(0, np.int64), np.zeros(0, U))
        size = np.bincount(row, minlength=n)
        regs = registers(row, h, n)
        d1, d2 = np.zeros(n, U), np.zeros(n, U)
        np.add.at(d1, row, mix(h ^ U(0xA0761D6478BD642F)))
        np.add.at(d2, row, mix(h ^ U(0xE7037ED1A0B428DB)))
        return pd.DataFrame({
            "n": size.astype(np.int64), "d1": d1.view(np.int64), "d2": d2.view(np.int64),
            "regs": [r.tobytes() if k else None for r, k in zip(regs, size, strict=True)],
        })

    return of_texts(docs, "text", "sig", "struct<n:bigint,d1:bigint,d2:bigint,regs:binary>", lambda: signed).select("doc_id", "sig.*")


ESTIMATES = "hub long, member long, core boolean, loose boolean, likely boolean"


def _estimated(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """``hub, member, core, loose, likely`` of ``hub, member``: where the estimate stands, slack included."""
    one = reps.select(F.col("rep").alias("hub"), F.col("n").alias("na"), F.col("regs").alias("ra"))
    two = reps.select(F.col("rep").alias("member"), F.col("n").alias("nb"), F.col("regs").alias("rb"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            a, b = (np.frombuffer(b"".join(pdf[c]), np.uint16).reshape(-1, REGISTERS) for c in ("ra", "rb"))
            na, nb = pdf["na"].to_numpy(float), pdf["nb"].to_numpy(float)
            est, slack = jaccard(a, b, na, nb), np.where(np.minimum(na, nb) < SMALL, MORE_SLACK, 0.0)
            yield pdf[["hub", "member"]].assign(core=est - slack >= CORE, loose=est + slack >= LOOSE, likely=est + slack >= PAIR)

    return pairs.join(two, "member").join(one, "hub").mapInPandas(run, ESTIMATES)


def _signed(rows: DataFrame) -> DataFrame:
    """``key, c``: buckets of ``key, rep`` with more than one member, one of those with equal membership."""
    groups = rows.groupBy("key").agg(F.count("*").alias("c"), F.min("rep").alias("low"), F.bit_xor(F.xxhash64("rep")).alias("x1"), F.bit_xor(F.xxhash64("rep", F.lit(1))).alias("x2"))
    return groups.where("c > 1").groupBy("c", "low", "x1", "x2").agg(F.min("key").alias("key")).select("key", "c")


def _dealt(rows: DataFrame, group: str, member: str, total: int, pack: int) -> DataFrame:
    """``group, member, block, pack, i, j, large`` of ``group, member, c``: groups of up to BLOCK members go together into
    packs of about ``pack`` rows; a larger one is cut into blocks by hash, and each pair of blocks is a cell."""
    width = F.ceil(F.col("c") / F.lit(BLOCK)).cast("int")
    r = rows.withColumn("block", F.pmod(F.xxhash64(member), width).cast("int"))
    r = r.select(group, member, "block", (width > 1).alias("large"), F.explode(F.transform(
        F.sequence(F.lit(0), width - 1), lambda k: F.struct(F.least(k, F.col("block")).alias("i"), F.greatest(k, F.col("block")).alias("j"))
    )).alias("cell"))
    place = F.when(F.col("large"), F.xxhash64(group)).otherwise(F.pmod(F.xxhash64(group), F.lit(max(1, total // pack))))
    return r.select(group, member, "block", place.alias("pack"), "cell.i", "cell.j", "large")


def _canopies(reps: DataFrame) -> DataFrame:
    """``hub, member, likely``: every pair of classes that share a band and have an estimate of PAIR or more is among
    the members of one hub, or a hub and its member.

    In each bucket the smallest class is the hub. Members near it (CORE) have all their partners of the bucket in its
    canopy and leave the bucket; a second round does the same with what is left. The remaining members are compared with
    each other by registers, in blocks of bounded size. Buckets of equal membership are one. No bucket is gathered.
    """
    band = F.explode(F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda i: F.xxhash64(i, F.substring("regs", i * 2 * ROWS + 1, F.lit(2 * ROWS)))))
    rows = reps.select("rep", band.alias("key"))
    # What joins a bucket's rows is staged first: then adaptive execution can split a hot bucket in the join.
    signed = stage(_signed(rows).select("key"), "keys")
    left = stage(rows.join(signed, "key"), "buckets")
    unstage(signed)
    found: list[DataFrame] = []
    for _ in range(HUB_ROUNDS):
        hubs = stage(left.groupBy("key").agg(F.min("rep").alias("hub")), "hubs")
        placed = left.join(hubs, "key").where("rep <> hub").select("key", "hub", F.col("rep").alias("member"))
        pairs = placed.select("hub", "member").distinct()
        for f in found:
            pairs = pairs.join(f.select("hub", "member"), ["hub", "member"], "left_anti")
        found.append(stage(_estimated(pairs, reps), "estimates"))
        far = functools.reduce(DataFrame.unionByName, found).where("NOT core").select("hub", "member")
        rest = placed.join(far, ["hub", "member"], "left_semi").select("key", F.col("member").alias("rep"))
        rest = stage(rest, "rest")
        unstage(left, hubs)
        signed = stage(_signed(rest), "keys")
        left = stage(rest.join(signed.select("key"), "key"), "buckets")
        unstage(rest, signed)
    signed = stage(_signed(left), "keys")
    sized = stage(left.join(signed, "key"), "rest")
    unstage(left, signed)
    cells = _dealt(sized, "key", "rep", sized.count(), 5 * PACK)
    close = cells.join(reps.select("rep", "n", "regs"), "rep").groupBy("pack", "i", "j", "large").applyInPandas(_close, "hub long, member long").distinct()
    every = functools.reduce(DataFrame.unionByName, found).where("loose").select("hub", "member", "likely")
    return every.unionByName(close.withColumn("likely", F.lit(True)))


def _close(pdf: pd.DataFrame) -> pd.DataFrame:
    """Pairs with an estimate of PAIR or more within each bucket (between its two blocks, if it has two)."""
    ids, n, side = pdf["rep"].to_numpy(), pdf["n"].to_numpy(float), pdf["block"].to_numpy()
    regs = np.frombuffer(b"".join(pdf["regs"]), np.uint16).reshape(-1, REGISTERS)
    a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for where in pdf.groupby("key").indices.values():
        split = len(set(side[where])) > 1
        for k, i in enumerate(where):
            others = where[k + 1 :]
            if split:
                others = others[side[others] != side[i]]
            est = jaccard(regs[i], regs[others], n[i], n[others]) + np.where(np.minimum(n[i], n[others]) < SMALL, MORE_SLACK, 0.0)
            others = others[est >= PAIR]
            a.append(np.minimum(ids[i], ids[others]))
            b.append(np.maximum(ids[i], ids[others]))
    return pd.DataFrame({"hub": np.concatenate(a), "member": np.concatenate(b)})


def _sets(texts: list[str], width: int) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Sorted shingle hashes of each text, their numbers, and the registers."""
    row, h = word_shingles(Block(texts), width)
    cut = np.searchsorted(row, np.arange(len(texts) + 1))
    return [h[a:b] for a, b in zip(cut[:-1], cut[1:], strict=True)], np.diff(cut).astype(float), registers(row, h, len(texts))


def _linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= percent * (len(x) + len(y) - both)


def _star(pdf: pd.DataFrame, width: int, percent: int) -> pd.DataFrame:
    """Members of a block of a large canopy against its hub, on full sets: links, and (with b null) the members that
    the hub doesn't link."""
    sets, _, _ = _sets(pdf["text"].tolist(), width)
    ids, hub = pdf["member"].to_numpy(), int(pdf["hub"].iloc[0])
    centre = [sets[k] for k in np.flatnonzero(ids == hub)]
    near = {int(i) for i, x in zip(ids, sets, strict=True) if i != hub and any(_linked(c, x, percent) for c in centre)}
    far = [int(i) for i in set(ids.tolist()) - near - {hub}]
    return pd.DataFrame({"hub": hub, "a": [hub] * len(near) + far, "b": pd.array([*near, *[None] * len(far)], "Int64")})


def _forest(pdf: pd.DataFrame, width: int, percent: int) -> pd.DataFrame:
    """Links that span the components of a pack of small canopies, or between the two sides of a cell of a large one;
    all candidates are compared by registers, and those that aren't joined yet by their full sets."""
    sets, n, regs = _sets(pdf["text"].tolist(), width)
    ids, side = pdf["member"].to_numpy(), pdf["side"].to_numpy()
    out = []
    for where in pdf.groupby("hub").indices.values():
        parent = {i: i for i in where}

        def root(i: int, parent: dict[int, int] = parent) -> int:
            while parent[i] != i:
                parent[i] = parent[parent[i]]
                i = parent[i]
            return i

        split = side[where[0]] >= 0
        for k, i in enumerate(where):
            if split and side[i]:
                continue
            others = where[(side[where] == 1) & (ids[where] != ids[i])] if split else where[k + 1 :]
            if not len(others):
                continue
            small, large = np.minimum(n[i], n[others]), np.maximum(n[i], n[others])
            others = others[(100 * small >= percent * large) & ((jaccard(regs[i], regs[others], n[i], n[others]) >= PAIR) | (small < SMALL))]
            for j in others:
                a, b = root(i), root(j)
                if a != b and _linked(sets[i], sets[j], percent):
                    parent[max(a, b)] = min(a, b)
                    out.append((ids[i], ids[j]))
    return pd.DataFrame(out, columns=["a", "b"], dtype=np.int64)


def _links(members: DataFrame, given: DataFrame, width: int, percent: int) -> DataFrame:
    """Staged ``a, b``: links that span the components within the canopies ``hub, member, c`` (the hub is a member too).

    Small canopies go together into packs. The members of a large one are first compared with their hub, block by block,
    which is linear; only members that the hub doesn't link meet all others, in cells of two blocks."""
    texts, _ = split_by_keys(given, "doc_id", members.select(F.col("member").alias("doc_id")))
    texts = texts.select(F.col("doc_id").alias("member"), "text")
    small = members.where(F.col("c") <= BLOCK)
    pack = F.pmod(F.xxhash64("hub"), F.lit(max(1, small.count() // PACK)))
    packs = small.select("hub", "member", F.lit(-1).alias("side"), pack.alias("pack")).join(texts, "member")
    links = stage(packs.groupBy("pack").applyInPandas(lambda pdf: _forest(pdf, width, percent), "a long, b long"), "links")
    large = members.where(F.col("c") > BLOCK)
    if large.isEmpty():
        return links
    blocks_of = lambda c: F.ceil(F.col(c) / F.lit(BLOCK)).cast("int")
    place = lambda c: F.pmod(F.xxhash64("member"), blocks_of(c)).cast("int")
    every = lambda c: F.explode(F.sequence(F.lit(0), blocks_of(c) - 1))
    stars = large.where("hub <> member").select("hub", "member", place("c").alias("block")).unionByName(
        large.where("hub = member").select("hub", "member", every("c").alias("block"))
    )
    star = stage(stars.join(texts, "member").groupBy("hub", "block").applyInPandas(lambda pdf: _star(pdf, width, percent), "hub long, a long, b long"), "stars")
    links = links.unionByName(star.where("b IS NOT NULL").select("a", "b"))
    far = star.where("b IS NULL").select("hub", F.col("a").alias("member"))
    if far.isEmpty():
        return links
    sizes = stage(far.groupBy("hub").agg(F.count("*").alias("u")).join(large.where("hub = member").select("hub", "c"), "hub"), "sizes")
    cells = far.join(sizes, "hub").select("hub", "member", F.lit(0).alias("side"), place("u").alias("i"), every("c").alias("j")).unionByName(
        large.join(sizes.select("hub", "u"), "hub").select("hub", "member", F.lit(1).alias("side"), every("u").alias("i"), place("c").alias("j"))
    )
    cross = cells.join(texts, "member").groupBy("hub", "i", "j").applyInPandas(lambda pdf: _forest(pdf, width, percent), "a long, b long")
    return links.unionByName(stage(cross, "cross"))


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, kept``: documents are linked where 100 * intersection >= percent * union of
    their sets of ``width``-word shingles (A-Z lowered).

    Documents of equal sets are one class first. Registers of all classes are banded; hubs of the buckets collect
    canopies, and in each canopy every pair that the corrected estimate doesn't rule out is compared on full sets,
    unless it is joined already. Links become components. Canopies are dealt in blocks of bounded size, so hot groups
    spread over many tasks; nothing is capped. A pair of similarity 0.8 misses all bands with probability 0.0002.
    ``percent`` must be 80 or more (the bounds of hubs and bands hold for that), else a ValueError.

    Null and blank texts have an empty set and link with nothing; rows with a null id share a class but give no id to
    it (alone, their component is null); repeated rows share their component. Empty tables give no rows; further
    columns aren't read.
    """
    if percent < 80:
        raise ValueError("percent must be 80 or more")
    given = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    with batches_of(docs.sparkSession, 2000):
        sig = stage(signatures(given, width), "signatures")
    reps = stage(
        sig.where("n > 0 AND doc_id IS NOT NULL").groupBy("n", "d1", "d2").agg(F.min("doc_id").alias("rep"), F.min_by("regs", "doc_id").alias("regs")),
        "classes",
    )
    found = stage(_canopies(reps), "canopies")
    # A hub with one member needs a likely pair; of more members any two may be one.
    sizes = found.groupBy("hub").agg(F.count("*").alias("c"), F.max("likely").alias("likely")).where("likely OR c > 1")
    sizes = stage(sizes.select("hub", (F.col("c") + 1).alias("c")), "sizes")  # staged: a hot hub's rows can then be split in the join
    members = stage(found.select("hub", "member").join(sizes, "hub").unionByName(sizes.withColumn("member", F.col("hub"))), "members")
    links = _links(members, given, width, percent)
    parts = connected_components(links)
    classes = reps.select("n", "d1", "d2", "rep").join(parts.withColumnRenamed("node", "rep"), "rep", "left").select(
        "n", "d1", "d2", F.coalesce("component", "rep").alias("component")
    )
    classes = stage(classes, "classes")
    unstage(found, sizes, members)
    joined = sig.select("doc_id", "n", "d1", "d2").join(classes, ["n", "d1", "d2"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id")
    )
    return joined.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))
