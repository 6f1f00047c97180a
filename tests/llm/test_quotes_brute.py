"""Quotation linking against a plain linker on generated threads: nesting, ties, repeats, repeated rows, long messages."""

from __future__ import annotations

import random
import re

from pyspark.sql import functions as F

from roadflow.llm import queries as llm
from roadflow.llm import quotes

WHITE = "[\x20\x09-\x0D]+"


def norm(t):
    return re.sub(WHITE, " ", t.translate({c: c + 32 for c in range(65, 91)})).strip(" ")


def split_runs(text):
    out = []
    for line in re.split(r"\r?\n", text or ""):
        mark = re.match(r"(?:\x20*>)+", line)
        level = mark[0].count(">") if mark else 0
        body = re.sub(r"^(?:\x20*>)+\x20?", "", line)
        if out and out[-1][0] == level:
            out[-1][1].append(body)
        else:
            out.append((level, [body]))
    return out


def cut(t):
    return re.split(r"(?<=[.!?])" + WHITE, t)


def brute(rows):
    """reply_to, thread and n_repeats by (conversation, turn)."""
    said, quoted, parts = {}, {}, {}
    for conv, turn, text in rows:
        if conv is None or turn is None:
            continue
        runs = split_runs(text)
        own = [lines for level, lines in runs if level == 0]
        lines = [x for r in own for x in r]
        small = {norm(x) for x in lines} | {norm(x) for r in own for x in cut(" ".join(r))}
        for k in small | {norm(" ".join(lines))} | {norm(" ".join(r)) for r in own}:
            if k:
                said[conv, k] = min(turn, said.get((conv, k), turn))
        parts.setdefault((conv, turn), set()).update(k for k in small if k.count(" ") >= quotes.REPEATED - 1)
        for level, q in runs:
            if level:
                for k in {norm(" ".join(q)), *map(norm, q), *map(norm, cut(" ".join(q)))} - {""}:
                    quoted.setdefault((conv, turn), set()).add((level, k))
    reply, repeats = {}, {}
    for key in parts:
        conv, turn = key
        found = [(-level, len(k), said[conv, k]) for level, k in quoted.get(key, ()) if said.get((conv, k), turn) < turn]
        mine = [(-quotes.UNMARKED, len(k), said[conv, k]) for k in parts[key] if said[conv, k] < turn]
        repeats[key] = len(mine)
        if found or mine:
            reply[key] = max(found + mine)[2]
    thread = {}
    for conv, turn in parts:
        t = turn
        while (conv, t) in reply:
            t = reply[conv, t]
        thread[conv, turn] = t
    return reply, thread, repeats


def threads(rng):
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 5))) for _ in range(60)]
    sentence = lambda: " ".join(rng.choice(words) for _ in range(rng.randint(1, 6))).capitalize() + rng.choice(".!?")
    rows = []
    for conv in range(25):
        past = []
        for turn in range(rng.randint(1, 14)):
            lines = []
            if past and rng.random() < 0.6:
                old = rng.choice(past).split("\n")
                a = rng.randrange(len(old))
                for line in old[a : a + rng.randint(1, 3)]:
                    lines.append(rng.choice([">", "> ", ">  ", " >"]) + (line.upper() if rng.random() < 0.2 else line))
            if past and rng.random() < 0.2:
                lines.append(rng.choice(cut(rng.choice(past).replace("\n", " "))))
            lines += [" ".join(sentence() for _ in range(rng.randint(1, 3))) for _ in range(rng.randint(0, 3))]
            if rng.random() < 0.1:
                lines.append("Ok then.")
            rng.shuffle(lines)
            text = "\n".join(lines)
            past.append(text)
            rows.append((conv, turn, text))
            if rng.random() < 0.05:
                rows.append((conv, turn, text))
    long = "\n".join(f"> line {i} of many." if i % 3 else f"line {i} of many." for i in range(20_000))
    return [*rows, (100, 0, long), (100, 1, "> line 3 of many.\nyes"), (101, None, "Ok then."), (None, 3, "> Ok then."), (102, 0, None), (102, 1, "")]


def test_links_are_those_of_a_plain_linker(spark):
    rows = threads(random.Random(4))
    reply, thread, repeats = brute(rows)
    assert len(reply) > 60 and sum(map(bool, repeats.values())) > 10
    d = spark.createDataFrame(rows, "conv_id long, turn long, text string").withColumns({"role": F.lit(None).cast("string"), "runs": F.lit(1), "level": F.lit(2), "h": F.lit(3)})
    got = quotes.link_quotes(d).collect()
    assert len(got) == len(rows)
    for r in got:
        key = (r.conv_id, r.turn)
        assert r.reply_to == reply.get(key)
        assert r.thread == thread.get(key, r.turn) and r.n_repeats == repeats.get(key, 0)
    for r in got:
        assert r.own_text == "\n".join(x for level, lines in split_runs(next(t for c, u, t in rows if (c, u) == (r.conv_id, r.turn))) if level == 0 for x in lines).strip(" \t\n\v\f\r")


def test_given_conversations_are_linked(spark):
    sf = "/root/testdata/sf0.1"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "text").collect()]
    reply, thread, repeats = brute(rows)
    got = {(r.conv_id, r.turn): r for r in llm.op8_quotes(spark, sf).collect()}
    assert reply and {k: r.reply_to for k, r in got.items() if r.reply_to is not None} == reply
    assert all(got[k].thread == t and got[k].n_repeats == repeats[k] for k, t in thread.items())
