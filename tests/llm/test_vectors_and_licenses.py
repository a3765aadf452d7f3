"""Whitening and vector codes against plain versions over whole tables; license detections against SQL and plain Python."""

import hashlib
import math
import re
from fractions import Fraction

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.test_operators import LONG, ODD, clashing, empty, odd, rows  # noqa: F401
from tidewright.llm import licenses, queries, signatures, vectorcode, whitening

SF = "/root/testdata/sf0.01"
VEC = "vec_id long, embedding array<float>, label int"
INF, NAN = float("inf"), float("nan")


@pytest.fixture(scope="module")
def embeddings(spark):
    return spark.read.parquet(f"{SF}/embeddings.parquet")


def finite(table):
    return [r for r in rows(table) if r["embedding"] is not None and all(x is not None and math.isfinite(x) for x in r["embedding"])]


# ---- 11 whitening


def brute_whitening(own, components):
    x = [[math.floor(64 * c) + 1_000_000 for c in r["embedding"]] for r in own]
    size = max(map(len, x), default=0)
    x = [v + [1_000_000] * (size - len(v)) for v in x]
    n, sums = len(x), [sum(c) for c in zip(*x, strict=True)]
    deviation = [sum((n * a - s) ** 2 for a, s in zip(v, sums, strict=True)) for v in x]
    centred = np.array([[float(Fraction(n * a - s, n)) for a, s in zip(v, sums, strict=True)] for v in x])
    cov = centred.T @ centred / n
    values, axes = np.linalg.eigh(cov)
    values, axes = values[::-1][:components], axes[:, ::-1][:, :components]
    return n, deviation, centred @ axes / np.sqrt(values), values / np.trace(cov)


def test_whitening_query_matches_brute_force(spark, embeddings):
    own = finite(embeddings)
    n, deviation, white, explained = brute_whitening(own, 32)
    got = rows(queries.op11_whitening(spark, SF))
    assert len(got) == 32 * len(own) and {r["n"] for r in got} == {n}
    place = {r["vec_id"]: i for i, r in enumerate(own)}
    out = np.zeros((len(own), 32))
    for r in got:
        i, c = place[r["vec_id"]], r["component"] - 1
        assert r["deviation"] == deviation[i] and r["explained"] == pytest.approx(explained[c], rel=1e-9) and r["identity_error"] <= 1e-9
        out[i, c] = r["whitened"]
    signs = np.sign((out * white).sum(0))
    assert np.abs(out * signs - white).max() < 1e-7
    assert np.abs(out.T @ out / n - np.eye(32)).max() < 1e-9


@pytest.mark.parametrize(("scale", "parts"), [(3, 1), (1000, 4), (2**40, 3)])
def test_tiles_add_up_exactly(spark, monkeypatch, scale, parts):
    """Also integers whose products need more than 53 bits, in tiles and blocks that don't divide the table."""
    monkeypatch.setattr(whitening, "TILE", 5)
    monkeypatch.setattr(whitening, "ROWS", 7)
    rng = np.random.default_rng(3)
    q = rng.integers(-scale, scale + 1, (50, 12))
    table = spark.createDataFrame([(x.tolist(),) for x in q], "v array<long>").repartition(parts)
    got = whitening.products(table, 12, lambda batch: np.array(batch.column("v").to_pylist(), np.int64).reshape(-1, 12))
    assert (got == q.astype(object).T @ q.astype(object)).all()


def test_whitening_odd(spark):
    some = [(i, [float(i % 3), i / 7, 1.0, -i / 5], i % 2) for i in range(9)]
    odd_rows = [(20, None, 1), (21, [1.0, None, 2.0, 3.0], 1), (22, [1.0, NAN, 2.0, 3.0], 1), (23, [INF, 1.0, 1.0, 1.0], None), (None, [2.0, 1.0], None), (24, [], 0), (3, [0.0, 3 / 7, 1.0, -3 / 5], 1)]
    table = spark.createDataFrame(some + odd_rows, VEC)
    more = table.select("*", F.lit(1).alias("deviation"), F.lit(1).alias("whitened"), F.lit("x").alias("Vec_Id"), F.lit(2).alias("v"))
    kept = finite(table)
    assert len(kept) == 12
    n, deviation, white, _ = brute_whitening(kept, 4)
    for t in (table, more):
        found, model = whitening.whiten(t)
        got = rows(found)
        assert model.n == n and len(got) == n and sorted(r["deviation"] for r in got) == sorted(deviation)
        assert {len(r["whitened"]) for r in got} == {len(model.values)} and model.identity_error < 1e-9
    huge = spark.createDataFrame([(1, [1e30, 0.0], 0), (2, [-1e30, 1.0], 0)], VEC)
    found, model = whitening.whiten(huge)
    assert {r["deviation"] for r in rows(found)} == {None} and model.n == 2
    for t in (table.limit(0), table.filter("vec_id = 20"), spark.createDataFrame([(i, [1.0, 2.0], 0) for i in range(5)], VEC), spark.createDataFrame([(1, [], 0)], VEC)):
        found, model = whitening.whiten(t)
        assert model is None and rows(found) == []


# ---- 12 vector codes


def brute_codes(own, k=16, rounds=6, parts=8):
    whole = [[math.floor(4096 * c) for c in r["embedding"]] for r in own]
    each = -(-max(map(len, whole), default=0) // parts)
    whole = [v + [0] * (parts * each - len(v)) for v in whole]
    cut = [[tuple(v[p * each : (p + 1) * each]) for p in range(parts)] for v in whole]
    first = {}
    for r, v in sorted(zip(own, cut, strict=True), key=lambda t: (t[0]["vec_id"] is None, t[0]["vec_id"] or 0, t[0]["embedding"])):
        first.setdefault(r["vec_id"], v)
    books = [[v[p] for v in list(first.values())[:k]] for p in range(parts)]
    square = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    near = lambda v, book: min(range(len(book)), key=lambda e: (square(v, book[e]), e))
    for _ in range(rounds):
        told = [[near(v[p], books[p]) for v in cut] for p in range(parts)]
        for p in range(parts):
            for e in range(len(books[p])):
                mine = [v[p] for v, t in zip(cut, told[p], strict=True) if t == e]
                if mine:
                    books[p][e] = tuple(sum(c) // len(mine) for c in zip(*mine, strict=True))
    out = []
    for r, v in zip(own, cut, strict=True):
        code = [near(v[p], books[p]) for p in range(parts)]
        out.append((r["vec_id"], r["label"], "".join(f"{c:02x}" for c in code), sum(square(v[p], books[p][c]) for p, c in enumerate(code))))
    by_label = {}
    for _, label, _, error in out:
        by_label[label] = by_label.get(label, 0) + error
    sha = hashlib.sha256(",".join(str(x) for book in books for entry in book for x in entry).encode()).hexdigest()
    return [(i, code, error, by_label[label]) for i, label, code, error in out], sha


def test_codes_query_matches_brute_force(spark, embeddings):
    want, sha = brute_codes(finite(embeddings))
    got = rows(queries.op12_vector_codes(spark, SF))
    assert sorted((r["vec_id"], r["code"], r["error"], r["label_error"]) for r in got) == sorted(want)
    assert {r["codebooks_sha256"] for r in got} == {sha}
    assert all(8 <= r["evaluated"] <= 128 for r in got) and sum(r["evaluated"] for r in got) < 0.95 * 128 * len(got)


@pytest.mark.parametrize("size", [1, 2, 3, 8, 12])
def test_bounds_lose_no_nearest_entry_and_no_tie(size):
    rng = np.random.default_rng(size)
    for spread in (1, 3, 1000, 1 << 27):
        v, entries = rng.integers(-spread, spread + 1, (300, size)), rng.integers(-spread, spread + 1, (9, size))
        entries[4] = entries[2]  # a tie each time
        v[:9] = entries
        far = ((v[:, None, :].astype(object) - entries.astype(object)) ** 2).sum(2)
        index, error, taken = vectorcode.nearest(v, entries)
        assert index.tolist() == [min(range(9), key=lambda e: (d[e], e)) for d in far.tolist()] and error.tolist() == [min(d) for d in far.tolist()]
        assert (taken >= 1).all() and taken.sum() <= 9 * 300


def test_bounds_leave_out_distant_entries():
    rng = np.random.default_rng(1)
    centres = rng.integers(-4000, 4000, (16, 8))
    v = centres[rng.integers(0, 16, 500)] + rng.integers(-50, 50, (500, 8))
    _, _, taken = vectorcode.nearest(v, centres)
    assert taken.mean() < 1.5


def test_codes_odd(spark):
    rng = np.random.default_rng(2)
    some = [(i // 2, [float(c) for c in np.float32(rng.normal(size=9))], [0, None, 2][i % 3]) for i in range(44)]
    odd_rows = [(50, None, 1), (51, [1.0, None], 1), (52, [NAN] * 9, 1), (53, [-INF] * 9, None), (None, [2.0, 1.0], None), (-1, [], 0), (3, some[6][1], 0)]
    table = spark.createDataFrame(some + odd_rows, VEC)
    more = table.select("*", F.lit(1).alias("code"), F.lit("x").alias("LABEL"), F.lit(2).alias("error"), F.lit(2).alias("own"))
    want, sha = brute_codes(finite(table))
    for t in (table, more):
        found, books = vectorcode.compress(t)
        assert sorted(map(str, ((r["vec_id"], r["code"], r["error"], r["label_error"]) for r in rows(found)))) == sorted(map(str, want)) and books.sha256() == sha
    few = spark.createDataFrame([(7, [1.0] * 8, 1), (None, [0.5] * 8, None), (7, [2.0] * 8, None)], VEC)
    want, sha = brute_codes(finite(few))
    found, books = vectorcode.compress(few)
    assert sorted((r["code"], r["error"], r["label_error"]) for r in rows(found)) == sorted(w[1:] for w in want) and books.entries.shape == (8, 2, 1)
    for t in (table.limit(0), table.filter("vec_id = 50")):
        assert rows(vectorcode.compress(t)[0]) == []
    huge = rows(vectorcode.compress(spark.createDataFrame([(1, [1e30] * 8, 1), (2, [-1e30] * 8, 1)], VEC))[0])
    assert [r["error"] for r in huge] == [0, 0] and len({r["code"] for r in huge}) == 2


# ---- 13 licenses

PLANTED = [
    "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
    "This program is free software under the GNU General Public License as published by the Free Software Foundation; either version 3 of the License, or (at your option) any later version.",
    "SPDX-License-Identifier: GPL-2.0-only WITH Linux-syscall-note", "Released under the MIT license. Copyright (c) 2019 Somebody", "CC BY CC BY-NC-SA 4.0 cc by", "All rights reserved. ALL RIGHTS RESERVED! all rights",
    "general public license general public", "Redistribution and use in source and binary forms, with or without modification, are permitted", "BSD 3-Clause License", "no license here", "ünder the mit license", "licenİse Kcc by", "cc by" + " word" * 60 + " cc by",
    "Creative Commons Attribution-ShareAlike 4.0 International", "apache apache apache 2.0 2.0", "Mozilla Public License Version 2.0, or the Eclipse Public License v2.0", "x" * 5000 + " gpl-3.0-or-later", "MIT-0", "0BSD\x00gplv3",
]


def brute_licenses(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    found = []
    for i, w in enumerate(words):
        for r in licenses.rules():
            if w in r.keywords and (m := re.match(r.pattern, " ".join(words[i:]) + " ")):
                found.append((i, i + m[0].count(" "), r.level, r.number, r.label))
    covers = lambda b, a: b[0] <= a[0] and b[1] >= a[1] and b[2] >= a[2] and (b[2] > a[2] or b[1] - b[0] > a[1] - a[0] or b[3] < a[3])
    kept = sorted(a for a in found if not any(covers(b, a) for b in found))
    base = sorted((i, label) for p, label in signatures.PHRASES.items() for i in range(len(words)) if words[i : i + len(p.split())] == p.split())
    return len(words), base, kept


def test_every_signature_is_found_by_its_own_words(spark):
    """The words of each rule, with every optional part left out and each choice as its first one, are detected as its label or lie within a longer one."""
    own = licenses.rules()
    assert len(own) > 250 and len({r.label for r in own}) > 150
    plain = []
    for r in own:
        p = r.pattern.removeprefix("^")
        p = re.sub(r"\[(.)[^]]*\]\??", r"\1", p.replace("[^ ]+", "x"))
        while "(" in p:  # innermost first: optional ones go, others become their first choice
            less = re.sub(r"\((?:\?:)?([^()]*)\)\?", "", p)
            p = less if less != p else re.sub(r"\((?:\?:)?([^()|]*)(\|[^()]*)?\)(\{[^}]*\})?", r"\1", p, count=1)
        plain.append(re.sub(r".\?", "", p.replace(r"\d", "7")))
    for r, text in zip(own, plain, strict=True):
        assert re.match(r.pattern, text.strip() + " "), (r, text)
        assert len(text.split()) < licenses.REACH
    got = {x["doc_id"]: x for x in rows(licenses.detect(spark.createDataFrame(list(enumerate(plain)), "doc_id long, text string")))}
    for r, text in zip(own, plain, strict=True):
        _, base, kept = brute_licenses(text)
        assert [tuple(d) for d in got[r.number]["detections"]] == kept and kept, (r, text)


def test_detections_match_brute_force(spark):
    mixed = [*PLANTED, " ".join(PLANTED), " -- ".join(PLANTED * 40), None, "", " \n", LONG]
    got = {r["doc_id"]: r for r in rows(licenses.detect(spark.createDataFrame(list(enumerate(mixed)), "doc_id long, text string")))}
    for i, text in enumerate(mixed):
        n, base, kept = brute_licenses(text)
        r = got[i]
        assert r["n_words"] == n and [tuple(b) for b in r["base"]] == base and [tuple(d) for d in r["detections"]] == kept
        best = max((d[2] for d in kept), default=0) / 5
        assert r["score"] == max(best, 0.4 if base else 0.0)
    labels = {r["doc_id"]: r["labels"] for r in rows(licenses.digest(licenses.detect(spark.createDataFrame(list(enumerate(PLANTED)), "doc_id long, text string"))))}
    assert labels[0] == "apache-2.0" and labels[1] == "gpl,gpl-3.0-or-later" and labels[3] == "copyright,mit" and labels[8] == "bsd-3-clause"


def test_phrases_that_overlap_themselves(spark):
    table = spark.createDataFrame([(1, "a b a b a, b")], "doc_id long, text string")
    assert [b["start"] for b in rows(licenses.detect(table, phrases={"a b a": "x"}))[0]["base"]] == [0, 2]


def test_license_query_matches_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS FROM read_parquet('{SF}/documents.parquet')")
    want = con.execute(queries.oracle_sql()["op13_license_scan"]).fetchall()
    got = queries.op13_license_scan(spark, SF).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)


def test_licenses_odd(odd, empty, clashing):  # noqa: F811
    got = rows(licenses.digest(licenses.detect(odd)))
    assert len(got) == len(ODD) and all(r["n_base"] == 0 and r["first_word"] is None and r["labels"] == "" and r["score"] == 0 for r in got)
    assert {r["n_words"] for r in got if r["doc_id"] in (1, 2, 3)} == {0} and next(r["n_words"] for r in got if r["doc_id"] == 6) == len(LONG.split())
    assert licenses.detect(empty).count() == 0
    assert sorted(map(str, rows(licenses.digest(licenses.detect(clashing))))) == sorted(map(str, got))
