"""Near-duplicate embeddings: dual traversal of cover trees with pruning by covering radii."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import batches_of, connected_components, stage, unstage
from .vectors import digests, dots, sizes_of, usable

#: Vectors in a block (one tree each) at most and, of smaller tables, at least; blocks that smaller tables are cut into.
BLOCK, LEAST_BLOCK, BLOCKS = 16384, 1024, 4
#: Size of the sample that gives the top cells, and their largest number; cells by which a tree is cut for a partner.
SAMPLE, CELLS, CUT = 2048, 1024, 512
#: Pairs of children from which on a matrix product pays.
MATRIX = 4096
#: Slack of distances, and of inner products, in single precision; what lies within it is compared in double precision.
SLACK, FUZZ = 2e-3, 2e-5


class CoverTree:
    """Nested levels over unit vectors: the cells of a level have half the radius of those above, and each lies within
    the cell that it splits. Rows are reordered so that every cell is a range [start, end) led by its centre;
    ``reach`` is the distance from there to the farthest row of the cell. Levels that split nothing are left out."""

    def __init__(self, x: np.ndarray, smallest: float):
        """From unit vectors, which are reordered in place; levels go down to a radius of at most ``smallest``."""
        self.order = np.arange(len(x))
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        starts, ends, radius = np.array([0]), np.array([len(x)]), 2.0
        self.x = x
        self._add(starts, ends)
        while radius > smallest and (ends - starts).max() > 1:
            radius /= 2
            cuts = []
            for s, e in zip(starts, ends, strict=True):
                if e - s == 1:
                    cuts.append(np.array([s]))
                    continue
                own = self._net(self.x[s:e], radius)
                by_cell = np.argsort(own, kind="stable")
                self.order[s:e] = self.order[s:e][by_cell]
                self.x[s:e] = self.x[s:e][by_cell]
                own = own[by_cell]
                cuts.append(s + np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1]))))
            before = len(starts)
            starts = np.concatenate(cuts)
            ends = np.concatenate((starts[1:], [len(x)]))
            if len(starts) > before:
                self._add(starts, ends)

    def _add(self, starts: np.ndarray, ends: np.ndarray) -> None:
        reach = np.zeros(len(starts), np.float32)
        for i in np.flatnonzero(ends - starts > 1):
            p = self.x[starts[i] : ends[i]]
            reach[i] = np.sqrt(np.maximum(2 - 2 * (p @ p[0]), 0)).max()
        self.levels.append((starts, ends, reach))

    @staticmethod
    def _net(x: np.ndarray, radius: float) -> np.ndarray:
        """Index of the centre that covers each row; the first row is a centre, then the first that none covers yet."""
        own = np.full(len(x), -1)
        least = 1 - radius * radius / 2
        free = np.arange(len(x))
        while len(free):
            block = free[:512]
            close = x[block] @ x[free].T >= least
            taken = np.zeros(len(free), bool)
            for i in range(len(block)):
                if not taken[i]:
                    new = close[i] & ~taken
                    new[i] = True
                    own[free[new]] = block[i]
                    taken |= new
            free = free[~taken]
        return own


def traverse(a: CoverTree, b: CoverTree, limit: float, same: bool, tally: Counter | None = None) -> Iterator[tuple[str, tuple[np.ndarray, ...]]]:
    """Both trees go down together: only pairs of cells whose centres are no farther apart than the limit and both
    covering radii go on to their children; all others are never looked at again.

    Yields ``rows``: rows i of a and j of b (in the trees' order) that may be within ``limit``, and ``cells``: start and
    end in a and in b of cells all of whose rows surely are. Each pair of rows comes once, with ``same`` as i <= j, where
    a row may also meet itself. ``tally`` counts the distances between centres and the pairs of rows.
    """
    tally = Counter() if tally is None else tally
    depth = max(len(a.levels), len(b.levels))
    at = lambda tree, k: tree.levels[min(k, len(tree.levels) - 1)]
    p, q = np.zeros(1, np.int64), np.zeros(1, np.int64)  # surviving pairs of cells of the level above
    low_a, high_a, low_b, high_b = (np.array([v]) for v in (0, len(at(a, 0)[0]), 0, len(at(b, 0)[0])))
    for level in range(depth):
        (sa, ea, ra), (sb, eb, rb) = at(a, level), at(b, level)
        on_p, on_q = [], []
        for i, j, sure in _children(a, b, level, low_a[p], high_a[p], low_b[q], high_b[q], p, limit, tally):
            if same:
                keep = sa[i] <= sb[j]  # ranges of a level are equal or disjoint
                i, j, sure = i[keep], j[keep], sure[keep]
            if sure.any():
                yield "cells", (sa[i[sure]], ea[i[sure]], sb[j[sure]], eb[j[sure]])
                i, j = i[~sure], j[~sure]
            ends = (ra[i] == 0) & (rb[j] == 0) if level < depth - 1 else np.ones(len(i), bool)
            yield from _every_row(sa[i[ends]], ea[i[ends]], sb[j[ends]], eb[j[ends]], same, tally)
            on_p.append(i[~ends])
            on_q.append(j[~ends])
        p, q = np.concatenate(on_p), np.concatenate(on_q)
        if not len(p) or level == depth - 1:
            return
        by = np.argsort(p, kind="stable")
        p, q = p[by], q[by]
        next_a, next_b = at(a, level + 1)[0], at(b, level + 1)[0]
        low_a, high_a = np.searchsorted(next_a, sa), np.searchsorted(next_a, ea)
        low_b, high_b = np.searchsorted(next_b, sb), np.searchsorted(next_b, eb)


def _ranges(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """All numbers of the ranges [low, high), one range after the other."""
    size = high - low
    ends = np.cumsum(size)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(low - (ends - size), size)


def _children(
    a: CoverTree, b: CoverTree, level: int, low_a: np.ndarray, high_a: np.ndarray, low_b: np.ndarray, high_b: np.ndarray, parent: np.ndarray, limit: float, tally: Counter
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Pairs of cells of the level, children of the given pairs of ranges, that may hold rows within the limit, and whether
    all of theirs surely are. The children of a cell of a that has many to meet are one matrix product, others go pair by
    pair; pairs are ordered by their ``parent`` in a."""
    (sa, _, ra), (sb, _, rb) = (t.levels[min(level, len(t.levels) - 1)] for t in (a, b))
    first = np.flatnonzero(np.concatenate(([True], parent[1:] != parent[:-1])))
    last = np.append(first[1:], len(parent))
    meets = np.add.reduceat((high_a - low_a) * (high_b - low_b), first)
    for s, e in zip(first[meets >= MATRIX], last[meets >= MATRIX], strict=True):
        rows, cols = np.arange(low_a[s], high_a[s]), _ranges(low_b[s:e], high_b[s:e])
        for k in range(0, len(rows), 512):
            some = rows[k : k + 512]
            tally["centres"] += len(some) * len(cols)
            i, j, sure = _near(a.x[sa[some]] @ b.x[sb[cols]].T, limit, ra[some], rb[cols])
            yield some[i], cols[j], sure
    few = np.repeat(meets < MATRIX, last - first)
    low_a, low_b, nb, size = low_a[few], low_b[few], (high_b - low_b)[few], ((high_a - low_a) * (high_b - low_b))[few]
    total = np.cumsum(size)
    for k in range(0, int(total[-1]) if len(total) else 0, 1 << 17):
        flat = np.arange(k, min(k + (1 << 17), int(total[-1])))
        pair = np.searchsorted(total, flat, side="right")
        inside = flat - (total[pair] - size[pair])
        i, j = low_a[pair] + inside // nb[pair], low_b[pair] + inside % nb[pair]
        tally["centres"] += len(i)
        apart = np.sqrt(np.maximum(2 - 2 * np.einsum("ij,ij->i", a.x[sa[i]], b.x[sb[j]]), 0))
        reach = ra[i] + rb[j]
        near = apart <= limit + SLACK + reach
        yield i[near], j[near], (apart + reach <= limit - SLACK)[near] & (reach > 0)[near]


def _near(near: np.ndarray, limit: float, ra: np.ndarray, rb: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of unit centres, from their inner products, whose cells may hold rows within the limit, and whether all of
    their rows surely are. Cells of one row have radius 0 and share one bound, so that they need a single comparison."""
    far = limit + SLACK
    u, v = np.divmod(np.flatnonzero(near >= np.float32(1 - far * far / 2)), near.shape[1])
    plain = (ra[u] == 0) & (rb[v] == 0)
    p, q, sure = [u[plain]], [v[plain]], [np.zeros(int(plain.sum()), bool)]
    wide_a, wide_b, plain_a = np.flatnonzero(ra > 0), np.flatnonzero(rb > 0), np.flatnonzero(ra == 0)
    for rows, cols, part in ((wide_a, np.arange(len(rb)), near[wide_a]), (plain_a, wide_b, near[:, wide_b][plain_a])):
        if part.size:
            apart = np.sqrt(np.maximum(2 - 2 * part, 0))
            reach = ra[rows, None] + rb[None, cols]
            u, v = np.nonzero(apart <= far + reach)
            p.append(rows[u])
            q.append(cols[v])
            sure.append(apart[u, v] + reach[u, v] <= limit - SLACK)
    return np.concatenate(p), np.concatenate(q), np.concatenate(sure)


def _every_row(sa: np.ndarray, ea: np.ndarray, sb: np.ndarray, eb: np.ndarray, same: bool, tally: Counter) -> Iterator[tuple[str, tuple[np.ndarray, ...]]]:
    """All rows of the cells of a with those of the cells of b (of the same cell each pair once), in parts of bounded size."""
    na, nb = ea - sa, eb - sb
    total = np.cumsum(na * nb)
    for k in range(0, int(total[-1]) if len(total) else 0, 1 << 18):
        flat = np.arange(k, min(k + (1 << 18), int(total[-1])))
        pair = np.searchsorted(total, flat, side="right")
        inside = flat - (total[pair] - na[pair] * nb[pair])
        i, j = sa[pair] + inside // nb[pair], sb[pair] + inside % nb[pair]
        if same:
            i, j = i[i <= j], j[i <= j]
        tally["rows"] += len(i)
        yield "rows", (i, j)


def components(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest reachable index of each of n nodes."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        np.minimum.at(new, label[i], low)
        np.minimum.at(new, label[j], low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


class Packed(CoverTree):
    """A tree with its ids, copies and original vectors, as bytes and back."""

    def __init__(self, ids: np.ndarray, copies: np.ndarray, exact: np.ndarray, levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]]):
        self.ids, self.copies, self.exact, self.levels = ids, copies, exact, levels
        wide = exact.astype(np.float64)
        self.norm = np.sqrt(dots(wide, wide))
        self.x = (wide / self.norm[:, None]).astype(np.float32)

    def packed(self) -> bytes:
        """Number of rows, of levels and of each level's cells, ids, copies, then of each level starts and reaches."""
        parts = [np.array([len(self.ids), len(self.levels), *[len(level[0]) for level in self.levels]], np.int64), self.ids.astype(np.int64), self.copies.astype(np.int64)]
        for starts, _, reach in self.levels:
            parts += [starts.astype(np.int32), reach.astype(np.float32)]
        return b"".join(p.tobytes() for p in parts)

    @staticmethod
    def read(tree: bytes, x: bytes, kind: type) -> "Packed":
        n, depth = (int(v) for v in np.frombuffer(tree, np.int64, 2))
        sizes = np.frombuffer(tree, np.int64, depth, 16)
        at = 16 + 8 * depth
        ids, copies = np.frombuffer(tree, np.int64, n, at), np.frombuffer(tree, np.int64, n, at + 8 * n)
        at += 16 * n
        levels = []
        for k in sizes.tolist():
            starts, reach = np.frombuffer(tree, np.int32, k, at).astype(np.int64), np.frombuffer(tree, np.float32, k, at + 4 * k)
            levels.append((starts, np.concatenate((starts[1:], [n])), reach))
            at += 8 * k
        return Packed(ids, copies, np.frombuffer(x, kind).reshape(n, -1), levels)

    def border(self, middle: np.ndarray, reach: float, limit: float) -> "Packed | None":
        """The part of the tree that can hold rows within the limit of the ball ``middle, reach``, None if none can: cells
        of the deepest level of at most CUT cells are its first level."""
        first = max(k for k, level in enumerate(self.levels) if len(level[0]) <= CUT or k == 0)
        starts, ends, wide = self.levels[first]
        apart = np.linalg.norm(self.x[starts].astype(np.float64) - middle, axis=1)
        near = apart <= wide + reach + limit + SLACK
        if not near.any():
            return None
        row = np.zeros(len(self.ids), bool)
        for s, e in zip(starts[near], ends[near], strict=True):
            row[s:e] = True
        if row.all():
            return self
        place = np.cumsum(row) - 1
        levels = []
        for s, _, r in self.levels[first:]:
            kept = row[s]  # a cell is in or out as a whole
            at = place[s[kept]]
            levels.append((at, np.concatenate((at[1:], [int(row.sum())])), r[kept]))
        return Packed(self.ids[row], self.copies[row], self.exact[row], levels)


class Tally:
    """Link counts and components of the rows of one or two trees, from what ``traverse`` yields; memory is bounded by the
    rows, however many links there are."""

    def __init__(self, a: Packed, b: Packed, same: bool, least: float):
        self.a, self.b, self.same, self.least = a, b, same, least
        self.n1, self.n2 = len(a.ids), len(b.ids)
        self.off = 0 if same else self.n1
        self.n = self.n1 if same else self.n1 + self.n2
        self.count = np.zeros(self.n, np.int64)
        self.more, self.own, self.glue = (np.zeros(self.n + 1, np.int64) for _ in range(3))
        self.sum_a, self.sum_b = (np.concatenate(([0], np.cumsum(t.copies))) for t in (a, b))
        self.edges: list[tuple[np.ndarray, np.ndarray]] = []
        self.held, self.label = 0, np.arange(self.n)

    def rows(self, i: np.ndarray, j: np.ndarray) -> None:
        a, b = self.a, self.b
        if self.same:
            i, j = i[i != j], j[i != j]
        near = np.einsum("ij,ij->i", a.x[i], b.x[j])
        maybe = near >= self.least - FUZZ
        i, j, near = i[maybe], j[maybe], near[maybe]
        sure = near >= self.least + FUZZ
        close = np.flatnonzero(~sure)
        if len(close):
            p, q = i[close], j[close]
            sure[close] = dots(a.exact[p], b.exact[q]) / (a.norm[p] * b.norm[q]) >= self.least
        i, j = i[sure], j[sure]
        np.add.at(self.count, i, b.copies[j])
        np.add.at(self.count, self.off + j, a.copies[i])
        self._tie(i, self.off + j)

    def cells(self, sa: np.ndarray, ea: np.ndarray, sb: np.ndarray, eb: np.ndarray) -> None:
        alone = (sa == sb) & self.same
        for s, e, w in ((sa, ea, self.sum_b[eb] - self.sum_b[sb]), (self.off + sb[~alone], self.off + eb[~alone], (self.sum_a[ea] - self.sum_a[sa])[~alone])):
            np.add.at(self.more, s, w)
            np.add.at(self.more, e, -w)
        np.add.at(self.own, sa[alone], 1)
        np.add.at(self.own, ea[alone], -1)
        for s, e in ((sa, ea), (self.off + sb, self.off + eb)):
            np.add.at(self.glue, s, 1)
            np.add.at(self.glue, e - 1, -1)
        self._tie(sa, self.off + sb)

    def _tie(self, i: np.ndarray, j: np.ndarray) -> None:
        new = self.label[i] != self.label[j]
        if new.any():
            self.edges.append((i[new], j[new]))
            self.held += int(new.sum())
            if self.held > max(1 << 20, 2 * self.n):
                self._settle()

    def _settle(self) -> None:
        i = np.concatenate([np.arange(self.n), *[e[0] for e in self.edges]])
        j = np.concatenate([self.label, *[e[1] for e in self.edges]])
        self.label, self.edges, self.held = components(self.n, i, j), [], 0

    def result(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, link counts and labels (indices) of all rows."""
        glued = np.flatnonzero(np.cumsum(self.glue)[:-1] > 0)
        self._tie(glued, glued + 1)
        self._settle()
        ids = self.a.ids if self.same else np.concatenate((self.a.ids, self.b.ids))
        copies = self.a.copies if self.same else np.concatenate((self.a.copies, self.b.copies))
        return ids, self.count + np.cumsum(self.more)[:-1] - copies * np.cumsum(self.own)[:-1], self.label


def link_vectors(vectors: DataFrame, least: float = 0.95, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``vec_id, n_links, component_id, kept``: links are all pairs of rows with cosine >= ``least`` in double precision.

    Equal vectors are one row with a count first. The distinct ones are dealt by the nearest of a few top centres
    (from a bounded sample) into blocks of bounded size with a cover tree each. Of two blocks only the parts that the
    other's covering ball can reach meet, and these traverse both trees. Pairs of cells that are near as a whole are
    counted as a whole. A block pair yields link counts and a spanning forest, never its pairs; nothing is capped.

    Vectors that are null, zero or hold null or non-finite components have no links and are their own component;
    vectors of different numbers of components don't link. Rows with a null id are left out of links and keep a null
    component. Rows that repeat an id count as one row each, and share their component. Empty tables give no rows.
    """
    kind = "double" if vectors.schema[vec_col].dataType.simpleString() == "array<double>" else "float"
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast(f"array<{kind}>").alias("x"))
    good = rows.where(F.col("vec_id").isNotNull() & usable(F.col("x"))).select("vec_id", "x", *digests(F.col("x")))
    classes = good.groupBy("h1", "h2").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"), F.min_by("x", "vec_id").alias("x"))
    classes = stage(classes.withColumn("d", F.size("x")), "classes")
    members = good.select("vec_id", "h1", "h2").join(classes.select("h1", "h2", "rep", "copies"), ["h1", "h2"])
    found = None
    for d in sizes_of(classes):
        links = _links(classes.where(F.col("d") == d), kind, least)
        found = links if found is None else found.unionByName(links)
    if found is not None:
        counts = found.where("n IS NOT NULL").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("n"))
        parts = connected_components(found.where("n IS NULL").select("a", "b")).withColumnRenamed("node", "rep")
        members = members.join(counts, "rep", "left").join(parts, "rep", "left")
    else:
        members = members.withColumn("n", F.lit(0)).withColumn("component", F.col("rep"))
    linked = members.groupBy("vec_id").agg(
        F.max(F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("links"), F.min(F.coalesce("component", "rep")).alias("component")
    )
    return (
        rows.select("vec_id").join(linked, "vec_id", "left")
        .select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "vec_id").alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
    )


def _links(classes: DataFrame, kind: str, least: float) -> DataFrame:
    """Staged ``a, b, n``: link counts (b null) and links that span the components (n null), by class."""
    n = classes.count()
    wide = np.float64 if kind == "double" else np.float32
    limit = float(np.sqrt(max(2 - 2 * least, 0)))
    size = min(BLOCK, max(LEAST_BLOCK, -(-n // BLOCKS)))
    part = min(1.0, SAMPLE / n)
    sample = classes.where(F.pmod(F.xxhash64("rep", F.lit("fit")), F.lit(1 << 20)) < part * (1 << 20)).select("rep", "x").toPandas().sort_values("rep")
    cells = int(min(CELLS, max(1, n // (2 * size))))
    top = np.stack(sample["x"].to_numpy()).astype(np.float64)[:cells] if len(sample) else None
    top = top / np.linalg.norm(top, axis=1, keepdims=True) if top is not None else None

    def dealt(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            if len(pdf):
                x = np.stack(pdf["x"].to_numpy()).astype(np.float64)
                yield pdf[["rep"]].assign(cell=np.int32(0) if top is None else (x @ top.T).argmax(axis=1).astype(np.int32))

    placed = classes.select("rep", "x").mapInPandas(dealt, "rep long, cell int")
    placed = stage(placed, "placed")
    sizes = {r["cell"]: r["count"] for r in placed.groupBy("cell").count().collect()}  # CELLS rows at most
    first, blocks = {}, 0
    for c in sorted(sizes):
        first[c] = (blocks, -(-sizes[c] // size))
        blocks += first[c][1]
    starts = F.create_map(*[F.lit(v) for c, (b, _) in first.items() for v in (c, b)])
    widths = F.create_map(*[F.lit(v) for c, (_, w) in first.items() for v in (c, w)])
    block = F.element_at(starts, F.col("cell")) + F.pmod(F.xxhash64("rep"), F.element_at(widths, F.col("cell"))).cast("int")

    def planted(pdf: pd.DataFrame) -> pd.DataFrame:
        x = np.stack(pdf["x"].to_numpy()).astype(wide)
        unit = x.astype(np.float64)
        unit /= np.sqrt(dots(unit, unit))[:, None]
        middle = unit.mean(axis=0)
        reach = float(np.linalg.norm(unit - middle, axis=1).max())
        tree = CoverTree(unit.astype(np.float32), limit / 2)
        o = tree.order
        whole = Packed(pdf["rep"].to_numpy(np.int64)[o], pdf["copies"].to_numpy(np.int64)[o], x[o], tree.levels)
        return pd.DataFrame({"block": [pdf["block"].iloc[0]], "tree": [whole.packed()], "x": [whole.exact.tobytes()], "middle": [middle.tolist()], "reach": [reach]})

    packs = classes.select("rep", "copies", "x").join(placed, "rep").withColumn("block", block).groupBy("block").applyInPandas(
        planted, "block int, tree binary, x binary, middle array<double>, reach double"
    )
    packs = stage(packs, "blocks")
    ball = packs.select("block", "middle", "reach")
    other = ball.select(F.col("block").alias("q"), F.col("middle").alias("middle2"), F.col("reach").alias("reach2"))
    apart = F.sqrt(F.aggregate(F.zip_with("middle", "middle2", lambda u, v: (u - v) * (u - v)), F.lit(0.0), lambda s, v: s + v))
    pairs = (
        ball.select(F.col("block").alias("p"), "middle", "reach", F.explode(F.sequence(F.lit(0), F.col("block"))).alias("q"))
        .join(other, "q")
        .where((F.col("p") == F.col("q")) | (apart <= F.col("reach") + F.col("reach2") + limit + SLACK))
    )
    pairs = stage(pairs.select("p", "q", "middle", "reach", "middle2", "reach2"), "pairs")

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            for r in pdf.itertuples(index=False):
                part = Packed.read(r.tree, r.x, wide)
                part = part if r.p == r.q else part.border(np.asarray(r.middle), r.reach, limit)
                if part is not None:
                    yield pd.DataFrame({"p": [r.p], "q": [r.q], "tree": [part.packed()], "x": [part.exact.tobytes()]})

    # Each side with the ball of its partner; the block itself meets itself once.
    sent = packs.select("block", "tree", "x")
    of_p = pairs.select("p", "q", F.col("middle2").alias("middle"), F.col("reach2").alias("reach")).join(sent.withColumnRenamed("block", "p"), "p")
    of_q = pairs.where("p <> q").select("p", "q", "middle", "reach").join(sent.withColumnRenamed("block", "q"), "q")
    kinds = "p int, q int, tree binary, x binary"
    left = of_p.select("p", "q", "middle", "reach", "tree", "x").mapInPandas(cut, kinds)
    right = of_q.select("p", "q", "middle", "reach", "tree", "x").mapInPandas(cut, kinds)

    def compare(one: pd.DataFrame, two: pd.DataFrame) -> pd.DataFrame:
        same = len(one) > 0 and one["p"].iloc[0] == one["q"].iloc[0]
        nothing = pd.DataFrame({c: pd.array([], "Int64") for c in ("a", "b", "n")})
        if not len(one) or not (same or len(two)):
            return nothing
        tree = Packed.read(one["tree"].iloc[0], one["x"].iloc[0], wide)
        other = tree if same else Packed.read(two["tree"].iloc[0], two["x"].iloc[0], wide)
        tally = Tally(tree, other, same, least)
        for what, found in traverse(tree, other, limit, same):
            getattr(tally, what)(*found)
        ids, total, label = tally.result()
        linked, tied = total > 0, label != np.arange(len(label))
        return pd.concat([
            pd.DataFrame({"a": ids[linked], "b": pd.array([None] * int(linked.sum()), "Int64"), "n": pd.array(total[linked], "Int64")}),
            pd.DataFrame({"a": ids[tied], "b": pd.array(ids[label[tied]], "Int64"), "n": pd.array([None] * int(tied.sum()), "Int64")}),
        ])

    with batches_of(classes.sparkSession, 2):  # a row is a block
        out = stage(left.groupBy("p", "q").cogroup(right.groupBy("p", "q")).applyInPandas(compare, "a long, b long, n long"), "links")
    unstage(placed, packs, pairs)
    return out
