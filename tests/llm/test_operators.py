"""Each operator against a brute-force version, an exact round trip or held-out accuracy, and on odd tables."""

import hashlib
import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from tidewright.llm import langid, lmscore, media, mixing, packing, quality, queries, simhash, toxicity, urlfilter, vptree

SF = "/root/testdata/sf0.01"
DOC = "doc_id long, text string, lang string, source string, n_chars long"
LONG = ("lorem ipsum dolor sit amet consectetur " * 4000).strip()
ODD = [
    (1, None, None, None, None), (2, "", "en", "src1", 0), (3, "   \n\t", "en", "src1", 5), (4, "one", "en", None, 3), (4, "one", "en", None, 3),
    (5, "one two", None, "src2", 7), (6, LONG, "en", "src1", 9), (7, "!!! ??? 123", "fr", "src3", 1), (None, "a nameless text of some words", "en", "src1", 2),
    (8, "日本語 のテキスト <|endoftext|> naïve ŝtrange", "ja", "src1", 2), (9, "one two", None, "src2", 7),
]


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, DOC)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOC)


@pytest.fixture(scope="module")
def clashing(odd):
    """Extra columns with the names of results and of other columns."""
    out = odd
    for name in ("score", "fp", "rep", "predicted", "domain", "copies", "k", "epochs", "component_id", "quality_score", "kept_id", "mix_cut", "TEXT", "media"):
        out = out.select("*", F.lit("x").alias(name))
    return out.select("*", F.lit(7).alias("Doc_Id"))


def rows(df):
    return [r.asDict() for r in df.collect()]


# ---- 1 MPEG audio


def test_media_round_trip(odd):
    got = {}
    for r in rows(media.digest(media.decode(media.encode(odd)))):
        got.setdefault(r["doc_id"], r)
    for doc_id, text, *_ in ODD:
        raw = (text or "").encode()
        payload = raw.ljust(max(192, -(-len(raw) // 192) * 192), b" ")
        r = got[doc_id]
        assert (r["n_bytes"], r["payload_bytes"]) == (len(raw), len(payload))
        assert r["payload_sha256"] == hashlib.sha256(payload).hexdigest() and r["tail_crc32"] == zlib.crc32(payload[-16:])
        assert " crc0 skip0 " in r["feature"] and r["seek"][0] > 240 and r["tags"]["TXXX:n_bytes"] == str(len(raw))
        assert r["frames"] == len(r["seek"]) and r["samples"] == 1152 * r["frames"] and r["duration_num"] * 48000 == r["samples"] * r["duration_den"]


def test_media_resynchronises_and_counts_damage():
    payload = bytes(i % 251 for i in range(192 * 9))
    clean = media.write(payload, len(payload))
    s = media.read(clean)
    assert media.payload_of(clean, s) == payload and s.tags["TXXX:n_bytes"] == str(len(payload))
    assert s.table["kind"] == "Xing" and s.table["frames"] == len(s.offsets) == 5 and len(s.table["toc"]) == 100
    assert s.samples == 5 * 1152 and s.duration() == (3, 25)
    junk = clean[: s.offsets[2]] + b"\xff\xfb junk \xff" + clean[s.offsets[2] :]
    t = media.read(junk)
    assert media.payload_of(junk, t) == payload and t.skipped == 9
    broken = bytearray(clean)
    broken[s.offsets[1] + 8] ^= 1  # in the side information
    assert media.read(bytes(broken)).bad_checksums == 1


@pytest.mark.parametrize(("four", "size", "samples", "rate"), [(b"\xff\xfb\x90\x00", 417, 1152, 44100), (b"\xff\xfd\xa4\x00", 576, 1152, 48000), (b"\xff\xf3\x40\xc0", 104, 576, 22050), (b"\xff\xff\x40\x00", 136, 384, 44100)])
def test_headers(four, size, samples, rate):
    h = media.header(four)
    want = (144 * h.bitrate * 1000 // rate) if h.layer == 2 or (h.layer == 3 and h.version == 1) else (72 * h.bitrate * 1000 // rate) if h.layer == 3 else 12 * h.bitrate * 1000 // rate * 4
    assert (h.size, h.samples, h.rate) == (want, samples, rate)


def test_headers_that_are_none():
    assert all(media.header(x) is None for x in (b"\xff\xfb\xf0\x00", b"\xff\xfb\x0c\x00", b"\xff\xe9\x90\x00", b"\x00\x00\x00\x00", b"\xff"))


def test_vbri_and_other_layers():
    frame = bytearray(417)
    frame[:4] = b"\xff\xfb\x90\x00"
    frame[36:62] = b"VBRI" + bytes(6) + (834).to_bytes(4, "big") + (1).to_bytes(4, "big") + (1).to_bytes(2, "big") + (1).to_bytes(2, "big") + (2).to_bytes(2, "big") + bytes(2)
    s = media.read(bytes(frame) + b"\xff\xfb\x90\x00" + bytes(413))
    assert s.table["kind"] == "VBRI" and s.table["frames"] == 1 and s.offsets == [417]
    assert media.read(b"").offsets == [] and media.read(b"\xff" * 50).offsets == []


def bits_of(*fields):
    """Fields (value, bits) one after another, as bytes."""
    text = "".join(f"{v:0{n}b}" for v, n in fields if n)
    return int(text.ljust(-(-len(text) // 8) * 8, "0"), 2).to_bytes(-(-len(text) // 8), "big")


def brute_crc(bits):
    crc = 0xFFFF
    for b in bits:
        crc = (crc << 1) & 0xFFFF ^ (0x8005 if int(b) ^ crc >> 15 else 0)
    return crc


@pytest.mark.parametrize(("four", "covered"), [
    (b"\xff\xfe\x40\x00", 256), (b"\xff\xfe\x40\x50", 4 * (8 * 2 + 24)), (b"\xff\xfe\x40\xc0", 128),
    # Layer II at 192 kbit/s of 44.1 kHz stereo (27 subbands); mono 32 kbit/s of 48 kHz (8); 22.05 kHz (30)
    (b"\xff\xfc\xa0\x00", 2 * (11 * 4 + 12 * 3 + 7 * 2)), (b"\xff\xfc\x14\xc0", 2 * 4 + 6 * 3), (b"\xff\xf4\x80\xc0", 4 * 4 + 7 * 3 + 19 * 2),
])
def test_checksums_of_layers_one_and_two(four, covered):
    h = media.header(four)
    body = bytearray(h.size)
    body[:4] = four
    if h.layer == 2:  # two subbands with an allocation: each channel of them also tells how its scale factors are shared
        body[6] = 0x11 if h.mono else 0x10
        covered += 2 * (2 if h.mono else 1)
    assert media.protected_bits(bytes(body), 0, h) == covered
    seen = "".join(f"{x:08b}" for x in (*body[2:4], *body[6:]))[: 16 + covered]
    body[4:6] = brute_crc(seen).to_bytes(2, "big")
    assert media.read(bytes(body) * 3).bad_checksums == 0 and len(media.read(bytes(body) * 3).offsets) == 3
    body[6 + (covered - 1) // 8] ^= 1 << (7 - (covered - 1) % 8)
    assert media.read(bytes(body) * 2).bad_checksums == 2


def test_free_format_and_encoder_delay():
    frame = b"\xff\xfb\x00\x00" + bytes(496)
    padded = b"\xff\xfb\x02\x00" + bytes(497)
    s = media.read(frame + padded + frame)
    assert s.offsets == [0, 500, 1001] and s.skipped == 0
    clean = media.write(bytes(192 * 6), 100)
    own = bytearray(clean)
    at = clean.index(b"Xing")
    own[at + 7] |= 8  # a quality field, then the encoder's name, 12 bits of delay and 12 of padding
    own[at + 120 : at + 129] = b"LAME3.100"
    own[at + 141 : at + 144] = (576 << 12 | 1000).to_bytes(3, "big")
    s = media.read(bytes(own))
    assert s.table["encoder"] == "LAME3.100" and (s.table["delay"], s.table["padding"]) == (576, 1000)
    assert s.duration()[0] * 48000 == (3 * 1152 - 1576) * s.duration()[1]


@pytest.mark.parametrize("units", [1, 2, 7, 200, 3001])
def test_seek_table_against_true_offsets(units):
    """The table's byte for each hundredth of the duration, worked out anew from the frames' offsets."""
    payload = bytes(192 * units)
    clean = media.write(payload, len(payload))
    s = media.read(clean)
    start = clean.index(b"Xing") - 23
    want = [min(255, (s.offsets[min(len(s.offsets) - 1, len(s.offsets) * i // 100)] - start) * 256 // s.table["bytes"]) for i in range(100)]
    assert s.table["toc"] == want and s.seek_error() == 0
    assert s.table["bytes"] == s.offsets[-1] + s.headers[-1].size - start
    broken = bytearray(clean)
    broken[clean.index(b"Xing") + 16 + 50] ^= 64
    assert media.read(bytes(broken)).seek_error() == 64


def test_media_odd(spark, empty, clashing):
    assert media.digest(media.decode(media.encode(empty))).count() == 0
    assert len(rows(media.digest(media.decode(media.encode(clashing))))) == len(ODD)
    none = rows(media.digest(media.decode(spark.createDataFrame([(1, None, "x"), (2, b"junk", "y")], "doc_id long, media binary, MEDIA string"))))
    assert [(r["payload_bytes"], r["frames"], r["seek"]) for r in none] == [(0, 0, []), (0, 0, [])]


# ---- 2 language


def brute_grams(text):
    words = "".join(c if c.isalpha() else " " for c in text.lower()).split()
    out = Counter()
    line = " " + " ".join(words) + " "
    for n in (1, 2, 3):
        for i in range(len(line) - n + 1):
            g = line[i : i + n]
            if (n == 1 and g == " ") or (n == 3 and g[1] == " "):
                continue
            out[g] += 1
    return out


def test_grams_match_brute_force():
    for text in ("The cat, the dog.", "à la carte ÉTÉ", "a", "x y z", "日本 語"):
        grams, n = langid.counts(text)
        decode = lambda g: "".join(chr(g >> s & 0x1FFFFF) for s in (42, 21, 0) if g >> s & 0x1FFFFF)
        assert {decode(int(g)): int(c) for g, c in zip(grams, n, strict=True)} == dict(brute_grams(text))
    assert len(langid.counts("12 !?")[0]) == 0


@pytest.mark.parametrize("size", [3, 7, 64])
def test_blocks_of_long_texts_change_nothing(monkeypatch, size):
    """N-grams and shingles of texts cut into blocks of a few characters."""
    texts = ["the cat  and\nthe dog 12 !! and the   bird", "", "  ", "a", "a b", "one two three four", "été " * 30, "x" * 40, "no end" + " " * 50]
    want = [(langid.counts(t), simhash.fingerprint(t), simhash._shingles(t, 5, 1).tolist()) for t in texts]
    monkeypatch.setattr(langid, "BLOCK", size)
    monkeypatch.setattr(simhash, "BLOCK", size)
    for t, ((grams, n), fp, shingles) in zip(texts, want, strict=True):
        own = langid.counts(t)
        assert own[0].tolist() == grams.tolist() and own[1].tolist() == n.tolist()
        assert simhash.fingerprint(t) == fp == brute_fingerprint(t) and simhash._shingles(t, 5, 1).tolist() == shingles


def test_out_of_place_matches_brute_force():
    texts = {"xx": "the cat and the dog and the bird", "yy": "der hund und die katze und der vogel"}
    orders = {k: langid.ranked(*langid.counts(t), 20) for k, t in texts.items()}
    profiles = langid.Profiles.of(orders, 20)
    own = langid.ranked(*langid.counts("der und and"), 20).tolist()
    out = {k: sum(abs(i - o.tolist().index(g)) if g in o.tolist() else 20 for i, g in enumerate(own)) for k, o in orders.items()}
    assert profiles.predict("der und and")[0] == min(out, key=lambda k: (out[k], k))


def test_language_training_matches_brute_force(documents):
    """Profiles that Spark counts over whole texts of the training fold, against plain counters of their n-grams."""
    plain = {}
    for r in rows(documents):
        if r["text"] and r["lang"] and zlib.crc32(str(r["doc_id"]).encode()) % 5:
            plain.setdefault(r["lang"], Counter()).update(brute_grams(r["text"]))
    code = lambda g: sum(ord(c) << s for c, s in zip(reversed(g), (0, 21, 42), strict=False))
    got = langid.train(documents)
    assert got.langs == sorted(plain)
    for lang, ranks in zip(got.langs, got.ranks, strict=True):
        own = np.flatnonzero(ranks[:-1] >= 0)
        order = got.grams[own[np.argsort(ranks[own])]].tolist()
        counted = {code(g): n for g, n in plain[lang].items()}
        assert order == sorted(counted, key=lambda g: (-counted[g], g))[: langid.TOP]


def test_language_accuracy(documents):
    got = langid.identify(documents).join(documents.select("doc_id", "lang"), "doc_id").filter("held_out")
    right = got.filter("lang_pred = lang").count() / got.count()
    assert right >= 0.97
    assert got.filter("score < 0 or score > 1").count() == 0


def test_language_odd(odd, empty, clashing):
    got = {r["doc_id"]: r for r in rows(langid.identify(odd))}
    assert got[1]["lang_pred"] == got[2]["lang_pred"] == got[7]["lang_pred"] == "und" and got[4]["lang_pred"] != "und"
    assert langid.identify(empty).count() == 0 and langid.identify(clashing).count() == len(ODD)


# ---- 3 and 7 classifiers


def test_quality_held_out(documents, labels):
    got = quality.score_documents(documents, labels).join(labels, "doc_id").filter("held_out")
    assert got.filter("predicted = quality").count() / got.count() >= 0.97


def test_toxicity_held_out(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    got = toxicity.score_documents(docs, labels).join(labels, "doc_id").filter("held_out")
    assert got.filter("predicted = toxic").count() / got.count() >= 0.95
    assert got.filter("predicted = 1 and size(spans) = 0").count() <= 2


def test_noisy_or_and_spans():
    e = toxicity.Evidence({"bad": 8.0, "vile-": 3.0}, -6.0)
    text = "All is well. You are bad! vileness here."
    found = e.sentences(text)
    p = [1 / (1 + math.exp(-2.0)), 1 / (1 + math.exp(3.0))]
    assert [text[a:b] for a, b, _ in found] == [" You are bad!", " vileness here."]
    assert e.score(text) == pytest.approx(1 - (1 - p[0]) * (1 - p[1])) and e.score("All is well. " * 5000) == 0


def test_trees_match_a_walk():
    rng = np.random.default_rng(0)
    x = rng.random((400, 5))
    y = ((x[:, 0] > 0.4) ^ (x[:, 3] > 0.7)).astype(float)
    forest = quality.fit(x, y, trees=15)
    for i in range(0, 400, 37):
        z = forest.base
        for f, t, v in zip(forest.feature, forest.threshold, forest.value, strict=True):
            at = 0
            while at < len(f):
                at = 2 * at + (2 if x[i, f[at]] > t[at] else 1)
            z += v[at - len(f)]
        assert forest.score(x[i : i + 1])[0] == pytest.approx(1 / (1 + math.exp(-z)))
    assert ((forest.score(x) >= 0.5) == y).mean() > 0.95


def brute_statistics(text):
    """The features of one text, byte by byte."""
    raw = (text or "").encode()
    if not raw:
        return dict.fromkeys(quality.FEATURES, 0.0)
    kinds = Counter()
    for b in raw:
        c = chr(b)
        kinds[
            "high" if b > 127 else "upper" if "A" <= c <= "Z" else "lower" if "a" <= c <= "z" else "digit" if c in "0123456789" else "newline" if c == "\n"
            else "space" if c in " \t\r\x0b\x0c\x1c\x1d\x1e\x1f" else "stop" if c in ".,;:'\"-()" else "loud" if c in "!?" else "pipe" if c == "|" else "symbol"
        ] += 1
    words, lines = raw.split(), [x for x in raw.split(b"\n") if x.strip()]
    out = {k: kinds[k] / len(raw) for k in ("upper", "lower", "digit", "space", "newline", "stop", "loud", "pipe", "symbol", "high")}
    n = max(1, len(words))
    return out | {
        "log_bytes": math.log(1 + len(raw)), "word_bytes": sum(len(w) for w in words) / n, "log_words": math.log(1 + len(words)), "distinct_words": len(set(words)) / n,
        "function_words": sum(w.decode(errors="replace") in quality.FUNCTION_WORDS for w in words) / n, "lines_repeated": 1 - len(set(lines)) / max(1, len(lines)),
        "words_a_line": math.log(1 + len(words) / max(1, len(lines))), "longest_word": math.log(1 + max((len(w) for w in words), default=0)),
    }


def test_quality_query_matches_brute_force(spark, documents, labels):
    """The registered query over its whole table: statistics by byte, and a walk down every tree."""
    forest = quality.train(documents, labels)
    texts = {r["doc_id"]: r["text"] for r in rows(documents)}
    got = {r["doc_id"]: r for r in rows(queries.op7_quality(spark, SF))}
    assert got.keys() == texts.keys()
    for doc_id, text in texts.items():
        own = brute_statistics(text)
        x = quality.statistics([text or ""])[0]
        assert np.allclose(x, [own[k] for k in quality.FEATURES], rtol=1e-9, atol=1e-12)
        z = forest.base
        for f, t, v in zip(forest.feature, forest.threshold, forest.value, strict=True):
            at = 0
            while at < len(f):
                at = 2 * at + (2 if x[f[at]] > t[at] else 1)
            z += v[at - len(f)]
        assert got[doc_id]["score"] == pytest.approx(1 / (1 + math.exp(-z)))
        assert got[doc_id]["held_out"] == (zlib.crc32(str(doc_id).encode()) % 3 == 1) and got[doc_id]["predicted"] == (got[doc_id]["score"] >= 0.5)


def brute_fit(bags, y, rounds, rate, l1, bias, rarest, smallest):
    """The proximal steps on the noisy-or likelihood, one word, sentence and document at a time."""
    df = Counter(w for own in bags for w in {w for s in own for w in s.split()})
    words = [w for w in df if df[w] >= rarest]
    theta, m1, m2 = (dict.fromkeys(words, 0.0) for _ in range(3))
    for t in range(1, rounds + 1):
        grad = dict.fromkeys(words, 0.0)
        for own, label in zip(bags, y, strict=True):
            ps = [1 / (1 + math.exp(-min(30, max(-30, bias + sum(theta.get(w, 0.0) for w in s.split()))))) for s in own]
            none = math.prod(1 - min(p, 1 - 1e-12) for p in ps)
            pull = none / max(1 - none, 1e-12) / len(y) if label else -2.0 / len(y)
            for s, p in zip(own, ps, strict=True):
                for w in s.split():
                    if w in grad:
                        grad[w] += pull * p
        for w in words:
            m1[w] = 0.9 * m1[w] + 0.1 * grad[w]
            m2[w] = 0.99 * m2[w] + 0.01 * grad[w] ** 2
            step = rate / (math.sqrt(m2[w] / (1 - 0.99**t)) + 1e-4)
            x = theta[w] + step * m1[w] / (1 - 0.9**t)
            theta[w] = math.copysign(max(0.0, abs(x) - step * l1), x)
    return {w: x for w, x in theta.items() if abs(x) >= smallest}


def test_toxicity_fit_matches_brute_force():
    rng = np.random.default_rng(5)
    texts, y = [], []
    for i in range(60):
        y.append(i % 3 == 0)
        sentences = [" ".join(f"word{k}" for k in rng.integers(0, 30, 6)) for _ in range(rng.integers(1, 5))]
        if y[-1]:
            sentences.insert(int(rng.integers(0, len(sentences) + 1)), "you are vile and word1")
        texts.append(". ".join(sentences))
    bags = [toxicity.bag(t) for t in texts]
    how = {"rounds": 40, "rate": 0.1, "l1": 4e-4, "bias": -6.0, "rarest": 5, "smallest": 0.5}
    got = toxicity.fit(bags, np.array(y, int), **how).weights
    want = brute_fit(bags, y, **how)
    assert got.keys() == want.keys() and "vile" in got and all(got[w] == pytest.approx(want[w], rel=1e-6) for w in want)


def test_toxicity_query_matches_brute_force(spark, documents, labels):
    """The registered query over its whole table: noisy-or of every sentence, worked out anew from the weights."""
    e = toxicity.train(documents, labels)
    got = {r["doc_id"]: r for r in rows(queries.op3_toxicity(spark, SF))}
    for r in rows(documents):
        none, n = 1.0, 0
        for m in toxicity.SENTENCES.finditer(r["text"] or ""):
            words = {"".join(g) for g in __import__("re").findall(r"[^\W_]+", m[0].lower())}
            own = [w for w in e.weights if (w in words if not w.endswith("-") else any(len(x) >= len(w) and x.startswith(w[:-1]) for x in words))]
            if own:
                p = 1 / (1 + math.exp(-e.bias - sum(e.weights[w] for w in own)))
                none, n = none * (1 - p), n + (p >= 0.5)
        assert got[r["doc_id"]]["score"] == pytest.approx(1 - none, abs=1e-12) and got[r["doc_id"]]["n_spans"] == n


def test_every_sentence_of_a_long_document_trains(spark):
    """The offending sentence of each toxic document stands behind thousands of others; equal sentences count as often as they stand there."""
    filler = ". ".join(f"sentence {i} of many" for i in range(3000))
    docs = [(i, f"{filler}. {'you are vile.' if i % 2 else 'you are kind.'}" + " and so on." * (i % 4), "en", "s", 1) for i in range(1, 25) if i % 5]
    marked = spark.createDataFrame([(d[0], d[0] % 2) for d in docs], "doc_id long, toxic int")
    table = spark.createDataFrame(docs, DOC)
    own = [d for d in docs if zlib.crc32(str(d[0]).encode()) % 5]
    assert len(toxicity.bag(docs[0][1])) == 3001 + docs[0][0] % 4
    e = toxicity.train(table, marked)
    assert e.weights == pytest.approx(toxicity.fit([toxicity.bag(d[1]) for d in own], np.array([d[0] % 2 for d in own])).weights) and e.weights["vile"] > 0


def test_sentences_counted_fit_as_sentences_repeated():
    rng = np.random.default_rng(11)
    bags = [[f"w{i} w{j}" for i, j in rng.integers(0, 9, (6, 2)) if i != j] for _ in range(40)]
    y = np.array([int(any("w3" in b.split() for b in own)) for own in bags])
    counts = [__import__("collections").Counter(b) for b in bags]
    want = toxicity.fit(bags, y, smallest=0.1).weights
    got = toxicity.fit([list(c) for c in counts], y, [list(c.values()) for c in counts], smallest=0.1).weights
    assert got == pytest.approx(want) and got


@pytest.mark.parametrize("operator", [quality, toxicity])
def test_classifiers_without_labels(spark, odd, operator):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r["score"] for r in rows(operator.score_documents(odd, none))} == {0.5 if operator is quality else 0.0}


def test_the_text_that_trains_is_the_least(spark):
    docs = spark.createDataFrame([(1, t, None, None, 1) for t in ("b", "a", "c")] * 3, DOC)
    got = rows(quality.labelled(docs, spark.createDataFrame([(1, 1)], "doc_id long, quality int"), "quality", 10, 1000, 999))
    assert got == [{"doc_id": 1, "text": "a", "y": 1}]


@pytest.mark.parametrize("operator", [quality, toxicity])
def test_classifiers_odd(spark, odd, empty, clashing, labels, operator):
    none = spark.createDataFrame([(None, None, None), (4, 1, 0), (4, 0, 1), (999, 1, 1)], "doc_id long, quality int, toxic int")
    for table, n in ((odd, len(ODD)), (empty, 0), (clashing, len(ODD))):
        got = rows(operator.score_documents(table, none))
        assert len(got) == n and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got)
    keep = quality.keep_good if operator is quality else toxicity.keep_clean
    assert keep(clashing, none).columns == clashing.columns


# ---- 4 language model


def brute_lm(texts, order, least):
    grams = Counter()
    tokens = sum(len(t.lower().split()) for t in texts)
    for t in texts:
        w = ["<s>", *t.lower().split()]
        grams["<s>",] += 1
        for n in range(1, order + 1):
            for i in range(1, len(w)):
                if i - n + 1 >= 0:
                    grams[tuple(w[i - n + 1 : i + 1])] += 1
    out = []
    for t in texts:
        w = ["<s>", *t.lower().split()]
        total = 0.0
        for i in range(1, len(w)):
            s = math.log(grams[(w[i],)] / tokens)
            for n in range(2, order + 1):
                if i - n + 1 < 0:
                    break
                g = tuple(w[i - n + 1 : i + 1])
                s = math.log(grams[g] / grams[g[:-1]]) if grams[g] >= least else math.log(0.4) + s
            total += s
        out.append(total)
    return out


@pytest.mark.parametrize("order", [1, 2, 3])
def test_lm_matches_brute_force(spark, documents, order):
    own = documents.filter("doc_id < 120")
    texts = {r["doc_id"]: r["text"] or "" for r in rows(own)}
    want = dict(zip(texts, brute_lm(list(texts.values()), order, 2), strict=True))
    got = {r["doc_id"]: r["score"] for r in rows(lmscore.score_documents(own.repartition(5), order, 2))}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], abs=1e-6) for k in want)


def test_lm_query_matches_brute_force_at_its_default(spark, documents):
    """The registered query over its whole table, at the default order of three."""
    texts = {r["doc_id"]: r["text"] or "" for r in rows(documents)}
    want = dict(zip(texts, brute_lm(list(texts.values()), 3, 1), strict=True))
    got = {r["doc_id"]: r["score"] for r in rows(queries.op4_lm_scoring(spark, SF))}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], abs=1e-6) for k in want)


@pytest.mark.parametrize("order", [1, 3, 4])
def test_lm_long_texts_go_on_in_the_next_shard(spark, documents, order, monkeypatch):
    """Texts cut over several shards score as whole ones do: at every cut the words before it are context."""
    monkeypatch.setattr(lmscore, "SHARD", 900)
    monkeypatch.setattr(lmscore, "BLOCK", 300)
    texts = {r["doc_id"]: r["text"] or "" for r in rows(documents.filter("doc_id < 40"))} | {900: "  " * 700, 901: " \n" * 400 + "one two one two three", 902: "", 903: "x" * 2000}
    want = dict(zip(texts, brute_lm(list(texts.values()), order, 2), strict=True))
    batch = pa.record_batch([pa.array(list(texts)), pa.array(list(texts.values()))], ["doc_id", "text"])
    monkeypatch.setattr(lmscore.TaskContext, "get", staticmethod(lambda: type("Task", (), {"partitionId": lambda self: 3})()))
    table = pa.Table.from_batches(lmscore._explode(iter([batch]), order, 60, 3))
    parts, answers = {}, []
    for r in table.to_pylist():
        parts.setdefault(r["bucket"] if r["part"] == "count" else ("words", r["shard"]), []).append(r)
    assert sum(isinstance(k, tuple) for k in parts) > 10
    for group in parts.values():
        answers += lmscore._total(pa.Table.from_pylist(group, table.schema)).to_pylist()
    got = Counter()
    for shard in {r["shard"] for r in answers}:
        for r in lmscore._sum(pa.Table.from_pylist([a for a in answers if a["shard"] == shard], table.schema), order, 2, 60).to_pylist():
            got[r["doc_id"]] += r["score"]
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], abs=1e-6) for k in want)


def test_lm_odd(odd, empty, clashing):
    got = rows(lmscore.score_documents(odd))
    assert len(got) == len(ODD) and all(r["score"] == 0 and r["mean"] is None for r in got if r["n_tokens"] == 0)
    assert lmscore.score_documents(empty).count() == 0 and lmscore.score_documents(clashing).count() == len(ODD)


# ---- 5 nearest neighbours


def brute_nearest(ids, x, k):
    scores = (x[:, None, :] * x[None]).sum(2)
    return {int(q): [int(ids[j]) for j in np.lexsort((ids, -scores[i])) if ids[j] != q][:k] for i, q in enumerate(ids) if q % 20 == 0}


def test_factor_one_is_exact_and_the_default_recalls(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    r = rows(df)
    ids, x = np.array([a["vec_id"] for a in r]), np.array([a["embedding"] for a in r], float)
    want = brute_nearest(ids, x, 20)
    for factor, least in ((1.0, 1.0), (None, 0.9)):
        got = {}
        for a in sorted(rows(vptree.nearest(df, factor=factor, shard=200)), key=lambda a: a["rank"]):
            got.setdefault(a["query_id"], []).append(a["vec_id"])
        hits = sum(len(set(got[q]) & set(w)) for q, w in want.items()) / sum(map(len, want.values()))
        assert hits >= least
        if factor == 1:
            assert got == want


def test_trees_prune_at_their_recall(spark):
    """On the table of sf0.1: what a fitted factor finds and how many inner products it takes; ties and lengths of integers at factor one."""
    r = rows(spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet"))
    ids, x = np.array([a["vec_id"] for a in r]), np.array([a["embedding"] for a in r], float)
    want = brute_nearest(ids, x, 20)
    shard = vptree.Shard(ids, x, float(np.sqrt((x**2).sum(1).max())))
    factor = vptree.fitted(x, shard.longest, 20)
    asked = ids % 20 == 0
    got = {}
    for q, v, _ in zip(*shard.search(ids[asked], x[asked], 20, factor), strict=True):
        got.setdefault(int(q), []).append(int(v))
    recall = sum(len(set(got[q]) & set(w)) for q, w in want.items()) / sum(map(len, want.values()))
    share = (shard.compared + shard.taken) / (len(ids) * asked.sum())
    assert recall >= 0.9 and share <= 0.5, (recall, share)
    z = np.random.default_rng(2).integers(-3, 4, (900, 5)).astype(float)
    z = z[(z != 0).any(1)]
    ids = np.arange(len(z)) * 4
    shard = vptree.Shard(ids, z, float(np.sqrt((z**2).sum(1).max())))
    found = {}
    for q, v, s in zip(*shard.search(ids[::5], z[::5], 7, 1.0), strict=True):
        found.setdefault(int(q), []).append(int(v))
    assert found == brute_nearest(ids, z, 7) and shard.compared < len(z) * len(ids[::5])


def test_nearest_odd(spark):
    schema = "vec_id long, embedding array<float>"
    more = spark.createDataFrame([(i, [float(i % 7), 1.0], "x", "y", 0) for i in range(50)], "vec_id long, embedding array<float>, VEC_ID string, score string, shard int")
    assert vptree.nearest(more, k=3).count() == 9
    bad = [(100, None), (120, []), (140, [0.0, 0.0]), (160, [1.0, None]), (180, [float("nan"), 1.0]), (200, [float("inf"), 0.0]), (None, [1.0, 1.0]), (220, [1.0, 2.0, 3.0])]
    same = [(i, [1.0, 0.5]) for i in range(60)] + [(20, [1.0, 0.5])]
    assert {r["reason"]: r["n"] for r in rows(vptree.left_out(spark.createDataFrame(bad + same, schema)))} == {"no vec_id": 1, "vector": 6, "dimension": 1}
    got = rows(vptree.nearest(spark.createDataFrame(bad + same, schema), k=5, shard=16))
    assert {r["query_id"] for r in got} == {0, 20, 40}
    assert [r["vec_id"] for r in sorted((r for r in got if r["query_id"] == 20), key=lambda r: r["rank"])] == [0, 1, 2, 3, 4]
    assert vptree.nearest(spark.createDataFrame([], schema)).count() == 0
    assert len(rows(vptree.nearest(spark.createDataFrame([(0, [1.0]), (1, [3.0])], schema)))) == 1


# ---- 6 packing


def check_packing(df, texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(packing.default_vocabulary())
    got = rows(df)
    docs, sequences = {}, {}
    for r in got:
        docs.setdefault(r["doc_id"], []).append(r)
        sequences.setdefault(r["sequence_id"], []).append(r)
    for doc_id, copies in texts.items():
        for text in set(copies):
            ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
            own = sorted((r for r in docs[doc_id]), key=lambda r: r["start"])
            assert sum(r["length"] for r in own) == len(ids) * len(copies)
            for r in own:
                assert r["doc_tokens"] == len(ids) and r["ids_crc32"] == zlib.crc32(ids[r["start"] : r["start"] + r["length"]].tobytes())
    for s in sequences.values():
        s.sort(key=lambda r: r["offset"])
        assert [r["offset"] for r in s] == np.cumsum([0, *(r["length"] for r in s)])[:-1].tolist() and sum(r["length"] for r in s) <= 2048
    return sum(r["length"] for r in got) / (2048 * len(sequences))


def test_packing_learns_ascii_words_from_the_model_straight():
    """Every printable ASCII character, long and odd words: ids as the whole tokenizer gives them, which isn't asked for them."""
    from types import SimpleNamespace

    own = packing.Words(packing.default_vocabulary())
    whole = own.tokenizer
    text = " ".join([*map(chr, range(33, 127)), "don't we'll 's''t !?!? a1b22 x" + "y" * 300, "The quick\tBROWN fox_jumps\n\nover--it."])
    own.tokenizer = SimpleNamespace(model=whole.model)  # has no encode
    assert [i.tolist() for i in own.ids([text, ""])] == [[*whole.encode(text, add_special_tokens=False).ids, 1], [1]]


def test_packing_documents(documents):
    fill = check_packing(packing.pack_documents(documents), {r["doc_id"]: [r["text"]] for r in rows(documents)})
    assert fill >= 0.98


def test_packing_odd(odd, empty, clashing):
    texts = {}
    for doc_id, text, *_ in ODD:
        texts.setdefault(doc_id, []).append(text)
    check_packing(packing.pack_documents(odd), texts)
    assert packing.pack_documents(empty).count() == 0 and packing.pack_documents(clashing).count() == packing.pack_documents(odd).count()


def test_repeated_rows_are_dealt_apart(spark):
    """A row that makes up most of the table is packed as often as it stands there, in many tasks."""
    df = spark.createDataFrame([(1, "the same words again", None, None, 1)] * 400 + [(2, "other words", None, None, 1)], DOC).repartition(3)
    cut = packing.pieces(df)
    assert cut.groupBy("doc_id").agg(F.countDistinct("copy").alias("n")).filter("doc_id = 1").first()["n"] > 100
    check_packing(packing.pack_documents(df), {1: ["the same words again"] * 400, 2: ["other words"]})


def test_karmarkar_karp():
    parts = packing.karmarkar_karp([8, 7, 6, 5, 4], 2)
    assert sorted(i for p in parts for i in p) == [0, 1, 2, 3, 4] and abs(sum([8, 7, 6, 5, 4][i] for i in parts[0]) - 15) <= 1
    assert len(packing.windows([1500, 1500, 1500], 2048)) == 3 and packing.windows([], 2048) == []


# ---- 8 mixing (also held against SQL by the driver)


def test_shortage_goes_to_siblings_before_ancestors(spark):
    leaves = spark.createDataFrame([("a", "x", "s1", 10), ("a", "x", "s2", 500), ("a", "y", "s3", 500), ("b", "x", "s4", 500)], "domain string, lang string, source string, leaf_tokens long")
    got = {r["source"]: r["share"] for r in rows(mixing.budgets(leaves, mixing.Targets(), F.lit(400).cast("long"), 1))}
    assert got == {"s1": 10, "s2": 90, "s3": 100, "s4": 200}
    small = leaves.withColumn("leaf_tokens", F.when(F.col("domain") == "a", 10).otherwise(F.col("leaf_tokens")).cast("long"))
    got = {r["source"]: r["share"] for r in rows(mixing.budgets(small, mixing.Targets(), F.lit(400).cast("long"), 1))}
    assert got == {"s1": 10, "s2": 10, "s3": 10, "s4": 370}


def test_mixing_keeps_to_shares(documents):
    got = rows(mixing.mix(documents, queries.TARGETS, **queries.MIX))
    leaves = {}
    for r in got:
        leaf = leaves.setdefault((r["domain"], r["lang"], r["source"]), [0, r["share"], 0, r["leaf_tokens"]])
        leaf[0] += r["copies"] * r["n_tokens"]
        leaf[2] = max(leaf[2], r["n_tokens"])
    assert all(share <= taken < share + longest + 1 and share <= 4 * tokens for taken, share, longest, tokens in leaves.values() if tokens)
    assert sum(v[1] for v in leaves.values()) == sum(r["n_tokens"] for r in got) * 80 // 100


def test_mixing_odd(odd, empty, clashing):
    assert mixing.mix(empty, queries.TARGETS, **queries.MIX).count() == 0 and mixing.mix(odd, queries.TARGETS, **queries.MIX).count() == len(ODD)
    taken = mixing.take(clashing, queries.TARGETS, 100)
    assert taken.columns == clashing.columns and sum(r["doc_id"] == 4 for r in rows(taken)) == 2
    assert mixing.take(odd, queries.TARGETS, 200, max_epochs=2).filter("doc_id = 6").count() == 2


# ---- 9 SimHash


def brute_fingerprint(text):
    words = bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode()).split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) > 2 else [b" ".join(words)] if words else []
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(pairs):
    parent = {}

    def find(a):
        while parent.setdefault(a, a) != a:
            a = parent[a]
        return a

    for i, (a, x) in enumerate(pairs):
        find(a)
        for b, y in pairs[:i]:
            if (x ^ y).bit_count() <= 3:
                r = sorted((find(a), find(b)))
                parent[r[1]] = r[0]
    return {a: find(a) for a, _ in pairs}


def test_simhash_matches_brute_force(spark, documents):
    r = rows(documents)
    pairs = [(a["doc_id"], brute_fingerprint(a["text"])) for a in r]
    want = brute_components(pairs)
    got = rows(simhash.near_duplicates(documents))
    assert {a["doc_id"]: a["fingerprint"] for a in got} == {a: f"{x:016x}" for a, x in pairs}
    assert {a["doc_id"]: a["component_id"] for a in got} == want


def test_links_lose_nothing_on_planted_neighbours(spark):
    rng = np.random.default_rng(1)
    fps = []
    for base in rng.integers(0, 2**63, 60, dtype=np.uint64).tolist():
        for flips in range(5):
            x = base
            for b in rng.choice(64, flips, replace=False).tolist():
                x ^= 1 << b
            fps.append(x)
    fps = sorted(set(fps))
    classes = spark.createDataFrame([(int(np.uint64(x).astype(np.int64)), i) for i, x in enumerate(fps)], "fp long, rep long")
    want = {(i, j) for i, x in enumerate(fps) for j, y in enumerate(fps) if j < i and (x ^ y).bit_count() <= 3}
    assert {(a["u"], a["v"]) for a in rows(simhash.links(classes))} == want


@pytest.mark.parametrize("together", [0, 100_000])
def test_components_of_random_edges(spark, monkeypatch, together):
    """In rounds over all tasks and in one task alike."""
    monkeypatch.setattr(simhash, "TOGETHER", together)
    rng = np.random.default_rng(8)
    pairs = [(int(max(a, b)) * 7 - 500, int(min(a, b)) * 7 - 500) for a, b in rng.integers(0, 300, (220, 2)) if a != b]
    root = {x: x for p in pairs for x in p}
    for _ in root:
        for u, v in pairs:
            root[u] = root[v] = min(root[u], root[v])
    got = {a["u"]: a["root"] for a in rows(simhash.components(spark.createDataFrame(pairs, "u long, v long")))}
    assert {u: r for u, r in got.items() if u != r} == {u: r for u, r in root.items() if u != r}
    assert not rows(simhash.components(spark.createDataFrame([], "u long, v long")))


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i + 1, i) for i in range(40)] + [(101, 100)], "u long, v long")
    got = {a["u"]: a["root"] for a in rows(simhash.components(edges))}
    assert got == {**{i: 0 for i in range(1, 41)}, 101: 100}


def test_simhash_odd(odd, empty, clashing):
    got = {a["doc_id"]: a for a in rows(simhash.near_duplicates(odd))}
    assert got[1]["fingerprint"] == "0" * 16 and got[1]["component_id"] == got[2]["component_id"] == got[3]["component_id"] == 1
    assert got[9]["component_id"] == 5 and simhash.near_duplicates(empty).count() == 0
    kept = rows(simhash.keep_one(clashing))
    assert sorted(a["doc_id"] for a in kept if a["doc_id"]) == [1, 4, 5, 6, 7, 8] and list(kept[0]) == clashing.columns


def brute_kept(r, least=800):
    """The least doc_id of each group of texts with similar word 5-grams, every pair compared."""
    sets = {}
    for a in r:
        w = bytes(b + 32 if 65 <= b <= 90 else b for b in (a["text"] or "").encode()).split()
        sets[a["doc_id"]] = frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4)))
    ids, root = sorted(sets), {}
    for i in ids:
        root[i] = i
        for j in {root[j] for j in ids if j < i and (n := len(sets[i] & sets[j])) * 1000 >= least * (len(sets[i]) + len(sets[j]) - n)}:
            low, high = sorted((root[i], j))
            root = {k: low if v == high else v for k, v in root.items()}
    return sorted(set(root.values()))


def test_keep_one_drops_edited_copies(spark, documents):
    """Copies of 0.8 and more that lie beyond three bits go too; in pairs, in a large group, and in a chain."""
    rng = np.random.default_rng(3)
    r = [a for a in rows(documents.select("doc_id", "text")) if a["doc_id"] in (1, 255, 2, 56, 643, 770, 582, 875, 709, 944) or a["doc_id"] % 9 == 0]
    base = [f"w{i}" for i in rng.integers(0, 5000, 400)]
    for k in range(40):  # each near the base, most not near one another
        words = list(base)
        for at in rng.choice(400, 9, replace=False).tolist():
            words[at] = f"x{k}"
        r.append({"doc_id": 10_000 + k, "text": " ".join(words)})
    r.append({"doc_id": 20_000, "text": " ".join(base)})
    r += [{"doc_id": 30_000 + k, "text": " ".join([f"c{i}" for i in range(20 * k, 20 * k + 400)])} for k in range(8)]
    r += [{"doc_id": 40_000, "text": None}, {"doc_id": 40_001, "text": "  "}, {"doc_id": 40_002, "text": "A  b"}, {"doc_id": 40_003, "text": "a b\n"}]
    want = brute_kept(r)
    got = sorted(a["doc_id"] for a in rows(simhash.keep_one(spark.createDataFrame([(a["doc_id"], a["text"]) for a in r], "doc_id long, text string"))))
    assert got == want and 10_000 in got and 20_000 not in got and 30_001 not in got and not {255, 56, 770, 875, 944} & set(got)


def test_null_and_shared_ids(spark):
    """A doc_id on two texts joins their classes; rows without one belong to their own class, and go as copies."""
    one, two, three, four = (" ".join(f"{c}{i}" for i in range(60)) for c in "pqrs")
    r = [(1, one), (10, one), (2, two), (10, two), (None, one), (None, three), (None, three), (None, three + " "), (None, four)]
    df = spark.createDataFrame(r, "doc_id long, text string")
    got = rows(simhash.near_duplicates(df))
    assert sorted((a["doc_id"] or 0, a["component_id"] or 0) for a in got) == [(0, 0)] * 4 + [(0, 1), (1, 1), (2, 1), (10, 1), (10, 1)]
    assert sorted((a["doc_id"] or 0, a["text"].strip()) for a in rows(simhash.keep_one(df))) == [(0, three), (0, four), (1, one), (2, two)]


# ---- 10 url rules (also held against SQL by the driver)


def test_urls(spark):
    urls = [None, "", "no scheme", "http://EXAMPLE.org/es/1", "http://a.b.example.org/en/12", "http://example.org/en/2", "http://example.org", "https://x.com/fr/", "https://x.com/de/?q", "http://xorg/", "http://com/de/", "http://x.org?/es/", "HTTPS://h.example.org/es/#f", "http://é.com/de/ü"]
    got = [(r["host"], r["path"], r["rule"], r["verdict"]) for r in urlfilter.judge(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string"), queries.RULES).orderBy("page_id").collect()]
    assert got == [
        ("", "", None, "allow"), ("", "", None, "allow"), ("", "", None, "allow"), ("example.org", "/es/1", "example.org/es/", "block"), ("a.b.example.org", "/en/12", "example.org/en/1", "block"),
        ("example.org", "/en/2", "org/", "allow"), ("example.org", "", None, "allow"), ("x.com", "/fr/", "com/fr/", "allow"), ("x.com", "/de/", "com/de/", "block"), ("xorg", "/", None, "allow"),
        ("com", "/de/", "com/de/", "block"), ("x.org", "", None, "allow"), ("h.example.org", "/es/", "example.org/es/", "block"), ("é.com", "/de/ü", "com/de/", "block"),
    ]


def test_cascade_is_exact_with_many_false_positives(spark):
    every = spark.range(3000).select(F.concat(F.lit("k"), "id").alias("key"))
    cascade = urlfilter.Cascade.build(every.filter("crc32(key) % 10 = 0"), every, first_rate=0.5)
    assert len(cascade.levels) > 2
    assert every.filter(cascade.contains(F.col("key")) != (F.expr("crc32(key) % 10 = 0"))).count() == 0
    assert every.filter(urlfilter.Cascade.build(every.limit(0), every).contains(F.col("key"))).count() == 0


def test_no_rules_and_no_urls(spark):
    none = spark.createDataFrame([], "page_id long, url string")
    assert urlfilter.judge(none, queries.RULES).count() == 0
    assert rows(urlfilter.judge(spark.createDataFrame([(1, "http://a/")], "page_id long, url string"), [], "block"))[0]["verdict"] == "block"


def test_rules_beyond_the_bits_are_joined_with_the_same_verdicts(spark):
    urls = spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url")
    more = urls.unionByName(spark.createDataFrame([(10**6, None), (10**6 + 1, "x"), (10**6 + 2, "http://a.example.org/es/" + "p" * 50_000)], "page_id long, url string"))
    want, got = (sorted(map(str, rows(urlfilter.judge(more, queries.RULES, max_bits=m)))) for m in (urlfilter.MAX_BITS, 1))
    assert got == want and len(got) == more.count()


@pytest.mark.parametrize("max_bits", [64, 128, 512, 4096])
def test_false_positives_beyond_a_level(spark, max_bits):
    """Level 1 of this corpus needs more bits than a level may have: level 0 gets a lower rate, or the rules are joined; verdicts stay."""
    more = [(i, f"http://h{i}.org/en/{i % 7}/x") for i in range(4000)] + [(10**6, "http://example.org/es/1")]
    pages = spark.createDataFrame(more, "page_id long, url string")
    want, got = (sorted(map(str, rows(urlfilter.judge(pages, queries.RULES, max_bits=m, first_rate=0.4)))) for m in (urlfilter.MAX_BITS, max_bits))
    assert got == want and len(got) == len(more)


def test_level_zero_is_built_again_for_a_lower_rate(spark, monkeypatch):
    monkeypatch.setattr(urlfilter, "FIRST_BITS", 64)
    every = spark.range(20_000).select(F.concat(F.lit("k"), "id").alias("key"))
    listed = every.filter("crc32(key) % 400 = 0")
    cascade = urlfilter.Cascade.build(listed, every, first_rate=0.5, max_bits=1024)
    assert all(level.bits <= 1024 for level in cascade.levels) and cascade.levels[0].hashes > 2
    assert every.filter(cascade.contains(F.col("key")) != (F.expr("crc32(key) % 400 = 0"))).count() == 0
    with pytest.raises(urlfilter.TooLarge):
        urlfilter.Cascade.build(every.limit(3000), every, first_rate=0.5, max_bits=1024)


def test_urls_odd(spark):
    twice = spark.createDataFrame([(1, "http://x.com/de/", "a", "b"), (1, "http://x.com/de/", "a", "b"), (None, "http://x.com/fr/", "a", "b")], "page_id long, url string, URL string, rule string")
    assert sorted((r["page_id"] or 0, r["rule"], r["verdict"]) for r in rows(urlfilter.judge(twice, queries.RULES))) == [(0, "com/fr/", "allow"), (1, "com/de/", "block"), (1, "com/de/", "block")]


def test_the_covering_leads_to_near_duplicates(spark, documents):
    """Without any band, what the fingerprints' covering links still is one group where whole sets agree."""
    words = [f"w{i}" for i in range(400)]
    texts = [" ".join(words), " ".join(words[:-1]), " ".join(words).upper(), " ".join(f"v{i}" for i in range(400))]
    fps = [simhash.fingerprint(t, 5, 42) for t in texts]
    assert (fps[0] ^ fps[1]).bit_count() <= 3
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bare = simhash._classes(df, 5, 42).withColumn("bands", F.array().cast("array<bigint>"))
    got = rows(simhash.similar_classes(bare, df))
    assert len(got) == 3 and len({r["root"] for r in got}) == 2
    assert sorted(a["doc_id"] for a in rows(simhash.keep_one(df))) == [0, 3]
