"""Whole documents against a chain that is walked word by word, feature by feature, in plain Python."""

from __future__ import annotations

import math
import re

import numpy as np

from roadflow.llm import language
from roadflow.llm.textvec import Block


def plain(model, text):
    """``lang_pred, score, n_words, n_switches`` of one text."""
    spaced = language.spaced(text)
    words = [(m.start(), m.end()) for m in re.finditer(rb"[A-Za-z\x80-\xff]+", spaced.encode())]
    if not any(c.isalpha() for c in text or "") or not words:
        return "und", 0.0, len(words), 0
    block, k = Block([spaced]), len(model.langs)
    begin = int(block.words(language.NOT_LETTERS)[0][0]) - words[0][0]  # where the text lies in the block

    def bucket(a, b, salt):
        h = int(block.hashes(np.array([begin + a]), np.array([begin + b]))[0])
        return (h ^ (salt * 0x9E3779B97F4A7C15 % 2**64)) >> (64 - language.DIM_BITS)

    scores = []
    for s, e in words:
        at = [bucket(s, e, 1)]
        at += [bucket(s, s + n, 2 + j) for j, n in enumerate(language.PREFIXES) if e - s >= n]
        at += [bucket(e - n, e, 2 + len(language.PREFIXES) + j) for j, n in enumerate(language.SUFFIXES) if e - s >= n]
        at += [bucket(i, i + 3, 100) for i in range(s, e - 2)]
        raw = [sum(float(model.weights[b, j]) for b in at) for j in range(k)]
        scores.append([math.exp(r - max(raw)) + 1e-12 for r in raw])
    move, start = np.exp(model.moves), np.exp(model.start)
    ahead, behind = [start * scores[0]], [np.ones(k)]
    for w in scores[1:]:
        v = (ahead[-1] / ahead[-1].sum()) @ move * w
        ahead.append(v)
    for w in reversed(scores[1:]):
        v = move @ (np.array(w) * behind[-1])
        behind.append(v / v.max())
    post = [a * b / (a * b).sum() for a, b in zip(ahead, reversed(behind), strict=True)]
    mean, best = np.mean(post, axis=0), [int(p.argmax()) for p in post]
    return model.langs[int(mean.argmax())], float(mean.max()), len(words), sum(a != b for a, b in zip(best, best[1:], strict=False))


def test_documents_equal_a_plain_chain(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = language.train(docs.where(language.fit_rows(docs.doc_id)))
    rows = [(r.doc_id, r.text) for r in docs.where("doc_id % 20 = 3 AND length(text) < 3000").collect()]
    texts = dict([*rows, (-1, ""), (-2, "123 --- !?"), (-3, "Straße ñandú œuvre"), (-4, rows[0][1][:80] + " " + rows[1][1][:80]), (-5, "x")])
    assert len(rows) >= 5
    got = {r.doc_id: r for r in language.predict(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), model).collect()}
    for ident, text in texts.items():
        lang, score, words, switches = plain(model, text)
        r = got[ident]
        assert (r.lang_pred, r.n_words, r.n_switches) == (lang, words, switches) and abs(r.score - score) < 1e-6
