"""The Merkle manifest against a plain one."""

from __future__ import annotations

import hashlib
import zlib
from itertools import groupby

import duckdb
import pytest
from pyspark.sql import functions as F

from roadflow.llm import merkle, queries
from tests.test_oracle import TABLES, rows

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def frame(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][i : i + 8])) for i in range(0, len(out[-1]), 8)])
    return out


def plain(docs):
    leaf = lambda r: sha("".join(frame(r[f]) for f in merkle.FIELDS))
    by_lang = lambda r: (r["lang"] is not None, (r["lang"] or "").encode())
    docs = sorted(docs, key=lambda r: (by_lang(r), r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
    groups = [list(g) for _, g in groupby(docs, key=by_lang)]
    trees = [(g, levels([leaf(r) for r in g])) for g in groups]
    top, out = levels([t[-1][0] for _, t in trees]), []
    for k, (group, tree) in enumerate(trees):
        for i, r in enumerate(group):
            way = []
            for lv, at in ((tree, i), (top, k)):
                for nodes in lv[:-1]:
                    run = nodes[at // 8 * 8 : at // 8 * 8 + 8]
                    way.append(("".join(run[: at % 8]), "".join(run[at % 8 + 1 :])))
                    at //= 8
            folded = tree[0][i]
            if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0:
                text = None if r["text"] is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in r["text"])
                folded = leaf({**r, "text": text})
            for a, b in way:
                folded = sha(a + folded + b)
            out.append((r["doc_id"], tree[0][i], tree[-1][0], top[-1][0], sha("".join(a + b for a, b in way)), folded, folded == top[-1][0]))
    return out


def some(n, langs):
    texts = ["Über Straßen", None, "", "plain", "A" * 5000, "ABC\n\tdef"]
    return [{"doc_id": k * 7919 + (1 << 60), "source": ["a", None, ""][k % 3], "lang": langs[k % len(langs)], "n_chars": None if k % 5 == 0 else k, "text": texts[k % 6]} for k in range(n)]


def as_frame(spark, docs):
    return spark.createDataFrame([tuple(d[f.split()[0]] for f in SCHEMA.split(", ")) for d in docs], SCHEMA)


def same(got, docs):
    key = lambda r: tuple(str(x) for x in r)
    assert sorted((tuple(r) for r in got.collect()), key=key) == sorted(plain(docs), key=key)


@pytest.mark.parametrize("n", [1, 8, 9, 600])
def test_one_language(spark, n):
    docs = some(n, ["en"])
    same(merkle.tampered(as_frame(spark, docs)), docs)


def test_many_languages_and_small_superblocks(spark):
    """Several rounds of superblocks in the trees and in the tree of subroots; null language, null and repeated ids."""
    langs = [None, "", *[f"l{k}" for k in range(11)]]
    docs = some(40, langs) + [{"doc_id": None, "source": None, "lang": None, "n_chars": None, "text": None}] * 2 + some(3, ["en"]) + some(700, ["big"])
    docs += [{**docs[-1], "text": "another Text"}, docs[-1]]
    third = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, F.lit(False))
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    same(merkle.manifest(as_frame(spark, docs), changes={"text": lower}, where=third, levels=1), docs)


def test_empty_and_clashing_names(spark):
    none = merkle.tampered(as_frame(spark, some(1, ["en"])).limit(0))
    assert none.count() == 0 and none.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    docs = some(20, ["en", "de"])
    clash = as_frame(spark, docs).withColumns({c: F.lit("x") for c in ("leaf", "root", "pos", "n", "tree", "key", "hash", "_at", "a.b")})
    same(merkle.tampered(clash), docs)


def test_query_and_sql(spark, sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    ours = queries.op11_merkle_manifest(spark, sf_dir).toPandas()
    assert rows(ours) == rows(con.execute(queries.OP11_SQL).fetchdf())
    docs = [r.asDict() for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert sorted(tuple(r) for r in ours.itertuples(index=False)) == sorted(plain(docs))
    assert 0 < ours["verified"].sum() < len(ours)
