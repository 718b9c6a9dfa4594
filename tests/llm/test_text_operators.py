"""Operators on single texts: quality, toxicity, language, personal data, WARC."""

import hashlib
import time
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from brightwell.llm import checks, langid, pii, quality, toxicity, warc
from tests.llm.helpers import SCHEMA, awkward, documents, prose, values

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def given(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{FOLDER}/labels.parquet")


# Quality

def plain_base(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    seen, repeats = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            repeats += line in seen
            seen.add(line)
    n = len(words)
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), repeats, len(covered), (
        n < 50 or 100 * len(covered) > 50 * n)


BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def test_base_figures_equal_a_plain_count(spark, given):
    docs = given.union(awkward(spark))
    more = documents(spark, [prose(9, 400) + "\n" + prose(9, 90), "a b c " * 300, " x\n\n x\n x\ty", "\x0b\x0c a\x1cb \r",
                             " ".join(f"{i % 150} {i % 150} z{i % 7}" for i in range(600))])
    docs = docs.union(more)
    found = docs.select("text", quality.measure(F.col("text")).alias("m")).select("text", *[f"m.{n}" for n in BASE]).collect()
    assert len(found) == docs.count()
    for row in found:
        assert tuple(row)[1:] == plain_base(row.text)


def js_distance(p, q):
    p, q = np.array(p) / sum(p), np.array(q) / sum(q)
    m = (p + q) / 2
    def half(x):
        return sum(a * np.log2(a / b) for a, b in zip(x, m) if a > 0)
    return np.sqrt((half(p) + half(q)) / 2)


def test_distance_is_jensen_shannon(spark):
    df = spark.createDataFrame([([1, 2, 3],), ([0, 0, 9],), ([0, 0, 0],)], "n array<long>")
    got = [r[0] for r in df.select(quality.distance(F.col("n"), [4, 1, 0])).collect()]
    assert got[:2] == pytest.approx([js_distance([1, 2, 3], [4, 1, 0]), 1.0])
    assert got[2] == 1.0


def test_histograms(spark):
    df = spark.createDataFrame([("The the of\tX1#é(~",), (None,)], "text string")
    made = df.select(quality.char_histogram(F.col("text")).alias("c"),
                     quality.word_histogram(quality.words_of(F.col("text")), ["of", "the"]).alias("w")).collect()
    assert made[0].c == [7, 3, 2, 1, 1, 1, 1, 1] and sum(made[0].c) == 17
    assert made[0].w == [1, 1, 2]
    assert sum(made[1].c) == 0 and made[1].w == [0, 0, 0]


def test_verdicts(spark):
    good = [prose(i, 150) for i in range(40)]
    bad = [prose(90, 150).upper(), " ".join(f"{w}##" for w in prose(91, 150).split())]
    found = {r.doc_id: r.kept for r in quality.judge(documents(spark, good + bad)).collect()}
    assert all(found[i + 1] for i in range(40))
    assert not found[41] and not found[42]


def test_quality_takes_awkward_rows(spark):
    docs = awkward(spark, extra=True)
    assert quality.judge(docs).count() == docs.count()
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns
    assert quality.judge(docs.limit(0)).count() == 0


@pytest.mark.parametrize("listed", [True, False])
def test_other_languages_are_held_against_their_own(spark, listed):
    words = "и в не на я быть он с что а по это она этот к но они мы река камень зима сад бумага окно гора письмо".split()
    def clean(seed, n=150):
        draw = random.Random(seed)
        return " ".join(draw.choice(words) for _ in range(n)) + "."
    rows = [(i, clean(i), "ru") for i in range(30)] + [(50, clean(50), "bg"), (51, clean(51), None)]
    rows += [(60, " ".join(f"{w}##" for w in clean(60).split()), "ru"), (61, clean(61, 20), "ru"),
             (62, " ".join(f"ж{random.Random(i).randrange(10 ** 6)}" for i in range(400)), "ru")]
    rows += [(100 + i, prose(i, 150), "en") for i in range(40 * listed)]
    docs = documents(spark, []).select("doc_id", "text", "lang").union(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    wanted = [i for i, *_ in rows if i not in (60, 61, 62)]
    assert sorted(r.doc_id for r in quality.judge(docs).where("kept").collect()) == wanted
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == wanted


@pytest.mark.parametrize("most", [10_000, 0])
def test_verdicts_of_any_language_equal_the_sql(spark, monkeypatch, most):
    """Languages of one document and of many, none, listed ones; references broadcast and joined by salt."""
    monkeypatch.setattr(quality, "BROADCAST_LANGS", most)
    def strange(seed, n=90, sign=""):
        draw = random.Random(seed)
        return " ".join("".join(draw.choice("абвгдежз") for _ in range(draw.choice([1, 1, 2]))) + sign for _ in range(n))
    rows = [(i, strange(i), "ru") for i in range(25)] + [(30, strange(30, sign="##"), "ru"), (31, strange(31), "bg"), (32, strange(32), None)]
    rows += [(40 + i, strange(40 + i, sign="#" * (i > 1)), "mk") for i in range(4)] + [(50, None, "mk"), (51, strange(51, 20), "sr")]
    rows += [(60 + i, prose(i, 150), "en") for i in range(30)] + [(95, strange(95), "en"), (96, prose(96, 150), "ru")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    documents = pd.DataFrame(rows, columns=["doc_id", "text", "lang"])
    wanted = duckdb.sql(checks.divergence()).fetchall()
    found = quality.judge(docs)
    assert sorted(map(tuple, found.collect())) == sorted(wanted)
    kept = {r[0] for r in wanted if r[-1]}
    assert {r.doc_id for r in quality.keep_good(docs).collect()} == kept and 31 in kept and not kept & {30, 50, 51, 95}


def test_one_more_document_turns_no_test_on(spark):
    """The limits of a language narrow little by little as documents of it come in."""
    m = spark.range(1, 2000).select(F.struct(F.array(*[F.lit(9).cast("long")] * quality.BINS).alias("chars"), F.lit(90).cast("long").alias("n_words"),
                                              F.array(F.lit(1), F.lit(89)).alias("commons")).alias("m"), F.col("id").alias("n"))
    other = (F.array(*[F.lit(k) for k in (11, 9, 9, 9, 9, 9, 9, 7)]), F.array(F.lit(1), F.lit(1)), F.array(F.lit(1), F.lit(1)), F.col("n"))
    found = [r[0] for r in m.select(quality.divergent(F.col("m"), {}, quality.Limits(chars=0.0, chance=0.0, min_chars=0), F.lit("ru"), other), "n").orderBy("n").collect()]
    assert not found[19] and found[-1] and found == sorted(found)


def test_clean_labels_are_kept(spark, given, labels):
    found = quality.judge(given).join(labels, "doc_id").where("NOT base_failed").groupBy("quality").agg(
        F.avg(F.col("kept").cast("int")).alias("share"))
    share = {r.quality: r.share for r in found.collect()}
    assert share[1] > 0.97 and share[0] < 0.4


# Toxicity

def test_machine_composes():
    machine = toxicity.grammar()
    state, out = 0, []
    for symbol in (toxicity.NEGATION, toxicity.OTHER, toxicity.INSULT, toxicity.END, toxicity.TARGET, toxicity.INSULT,
                   toxicity.REPORT, toxicity.THREAT):
        state, mark = machine.step(state, symbol)
        out.append(mark)
    assert out[2] == toxicity.NEGATED_INSULT
    assert out[5] == toxicity.AIMED_INSULT
    assert out[7] == toxicity.REPORTED_THREAT


def test_clauses_matter():
    model = toxicity.seeded()
    reader = toxicity.Reader(model)
    def score(text):
        return model.score(reader.sums(text)[None])[0]
    assert score("you idiot") > score("an idiot") > score("she said he is an idiot") > score("a fine day")
    assert score("he is not an idiot") < score("he is an idiot")
    assert score("i will hurt you") < score("you, i will hurt")
    assert score("") == score("nothing to see") < toxicity.THRESHOLD


def test_learns_words_and_beginnings(spark):
    texts = [f"{prose(i, 30)} {'blorkan' if i % 4 == 0 else 'blorkist' if i % 4 == 1 else 'fine'}." for i in range(200)]
    docs = documents(spark, texts)
    marks = spark.createDataFrame([(i + 1, 0, int(i % 4 < 2)) for i in range(200)], "doc_id long, quality int, toxic int")
    found = {r.doc_id: r for r in toxicity.judge(docs, marks).collect()}
    assert all(found[i + 1].predicted == int(i % 4 < 2) for i in range(200))
    assert {r.doc_id for r in found.values() if r.held_out} == {i for i in range(1, 201) if zlib.crc32(str(i).encode()) % 4 == 2}


def test_counts_bear_texts_without_a_word(spark):
    rows = spark.createDataFrame([("ab",), ("12 !",), (None,)], "text string").repartition(9, "text")
    assert {r.entry: r.n for r in toxicity._counted(rows).collect()} == {"=ab": 1}


def test_held_out_toxicity(spark):
    folder = "/root/testdata/sf0.1"
    docs, marks = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    found = toxicity.judge(docs, marks).join(marks, "doc_id").where("held_out").toPandas()
    toxic = found["toxic"] == 1
    assert (found["predicted"][toxic] == 1).mean() > 0.85
    assert (found["predicted"][~toxic] == 0).mean() > 0.98


def test_toxicity_takes_awkward_rows(spark):
    docs = awkward(spark, extra=True)
    marks = spark.createDataFrame([(1, None, None), (None, 1, 1), (8, 1, 1), (8, 0, 0)], "doc_id long, quality int, toxic int")
    found = toxicity.judge(docs, marks)
    assert found.count() == docs.count() and found.where("score IS NULL OR score < 0 OR score > 1").count() == 0
    assert toxicity.judge(docs.limit(0), marks.limit(0)).count() == 0


# Language

def test_languages_are_told_apart(spark, given):
    found = langid.identify(given).join(given, "doc_id").where("held_out AND length(text) > 200").toPandas()
    assert len(found) > 20 and (found["lang_pred"] == found["lang"]).mean() > 0.9
    assert found["score"].between(0, 1).all()


def test_language_of_awkward_rows(spark):
    docs = awkward(spark, extra=True)
    found = langid.identify(docs)
    assert found.count() == docs.count()
    blank = docs.where("text IS NULL OR NOT text RLIKE '[a-z]'").count()
    assert found.where("lang_pred = 'und' AND score = 0").count() == blank
    none = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in langid.identify(none).collect()} == {"und"}
    assert langid.identify(docs.limit(0)).count() == 0


def test_gram_counts_do_not_depend_on_chunks(monkeypatch):
    text = prose(5, 200) + " 12 été"
    whole = langid.counts(text)
    monkeypatch.setattr(langid, "CHUNK", 7)
    assert (langid.counts(text) == whole).all()


def test_rejection():
    draw = np.random.default_rng(1)
    rows = np.abs(draw.normal(size=(20, 6))) + np.array([9, 0, 0, 0, 0, 0])
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    model = langid.Model(["en"], langid.clustered(rows, 1), np.array([0.9]), np.ones(6))
    _, score, rejected = model.predict(np.array([[9.0, 1, 0, 0, 0, 0], [0, 0, 0, 0, 0, 9.0]]))
    assert rejected == [False, True] and score[0] > score[1]


# Personal data

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain_spans(text):
    found = [("email", m.start(), m.end()) for m in EMAIL.finditer(text)]
    found += [("ip", m.start(), m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        digits = [int(c) for c in m[0] if c.isdigit()]
        total = sum(d if i % 2 == 0 else 2 * d - 9 * (d > 4) for i, d in enumerate(reversed(digits)))
        if 16 <= len(digits) <= 19 and total % 10 == 0:
            found.append(("card", m.start(), m.end()))
    found += [("phone", m.start(), m.end()) for m in PHONE.finditer(text) if 8 <= sum(c.isdigit() for c in m[0]) <= 15]
    return found


TRICKY = ["a@b.com_foo@bar.org", "x@y", "@b.com a@b..c", "1.2.3.4.5.6.7.8 300.1.1.1 0.0.0.0255", "4111 1111 1111 1111",
          "4111-1111-1111-1112", "+1 (255) 555-8013", "+1+44 20 7946 0958", "é a.b+c@d-e.fr. ünï@x.de", "12 4111111111111111",
          "+1 (255) 555-8013 4587121519400672", "a@b.c@d.e", "+12 345", "4111111111111111 4111111111111111"]


def test_strict_spans_equal_the_patterns(given):
    texts = TRICKY + [r.text or "" for r in given.collect()] + ["".join(t) for t in zip(*[iter(TRICKY)] * 2)]
    for text in texts:
        assert pii.base_spans(text) == plain_spans(text)


def test_broken_matches_are_won_back(spark):
    def card(i):
        digits = f"4{i:014d}"
        return digits + next(str(d) for d in range(10) if pii.luhn(digits + str(d)))
    texts = [f"{prose(i, 20)} card {card(i * 7919)} and +1 (2{i % 90 + 10}) 555-{1000 + i} mail a{i}@mail.example.com "
             f"order {i:012d} took {i}.{i} of {i}.2.3" for i in range(300)]
    glued = [f"call +1 (255) 555-8013 {card(i * 104729 + 13)} now" for i in range(20)]
    docs = documents(spark, texts + glued)
    model = pii.fit(docs)
    assert model.trees is not None
    found = {r.doc_id: r for r in pii.find(docs, model).collect()}
    won = sum("card:" in found[i + 301].spans for i in range(20))
    assert won >= 18 and all(found[i + 301].n_card == 0 for i in range(20))
    for i in range(300):
        assert found[i + 1].spans == pii.listed(plain_spans(texts[i]))


def test_cards_of_many_groups_are_proposed_and_won_back(spark):
    def card(i):
        digits = f"4{i:014d}"
        return digits + next(str(d) for d in range(10) if pii.luhn(digits + str(d)))
    texts = [f"{prose(i, 20)} card {card(i * 7919)} paid" for i in range(150)]
    texts += [f"{prose(i, 20)} card {' '.join(card(i * 7919))} paid" for i in range(150, 300)]
    broken = [f"pay {' '.join(card(i * 104729 + 13))} 1234 now" for i in range(20)]
    for text in broken:
        assert (4, 35) in {(p.start, p.end) for p in pii.proposals(text, list(pii.base_matches(text)))}
    docs = documents(spark, texts + broken)
    found = {r.doc_id: r.spans for r in pii.find(docs, pii.fit(docs)).collect()}
    assert sum("card:4:35" in found[i + 301] for i in range(20)) >= 15


def test_base_digest_and_masks(spark):
    docs = documents(spark, ["mail a@b.com or 1.2.3.4", None, ""])
    model = pii.Model(None)
    found = {r.doc_id: r for r in pii.find(docs, model).collect()}
    assert found[1].base_sha256 == hashlib.sha256(b"email:5:12,ip:16:23").hexdigest()
    assert (found[1].n_email, found[1].n_ip, found[1].spans) == (1, 1, "email:5:12,ip:16:23")
    assert found[2].base_sha256 == hashlib.sha256(b"").hexdigest() and found[2].spans == ""
    masked = {r.doc_id: (r.text, r.n_chars) for r in pii.redact(docs, model).collect()}
    assert masked == {1: ("mail [EMAIL] or [IP]", 20), 2: (None, None), 3: ("", 0)}


def test_personal_data_takes_awkward_rows(spark):
    docs = awkward(spark, extra=True)
    model = pii.fit(docs)
    assert pii.find(docs, model).count() == docs.count()
    assert pii.redact(docs, model).columns == docs.columns
    assert values(pii.redact(docs, model)) == values(docs.withColumn("n_chars", F.coalesce(F.char_length("text").cast("long"), "n_chars")))
    assert pii.find(docs.limit(0), pii.fit(docs.limit(0))).count() == 0


def test_trees_learn_an_interaction():
    draw = np.random.default_rng(0)
    x = draw.random((2000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.3)).astype(float)
    trees = pii.Boosted().fit(x, y)
    assert ((trees.raw(x) > 0) == y).mean() > 0.97


# WARC

PAGE = ('<html lang="de"><head><title>A &amp; B</title><script>x("</p>")</script></head><body><!-- <p>no</p> --><h1>Head</h1>'
        '<p>One <b>two</b>&nbsp;three<br>four &lt;five&gt;</p><a href="/x">link</a></body></html>')


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_derivatives(spark):
    found = {r.record_type: r for r in warc.build(pages(spark, [(1, "http://a/", PAGE)])).collect()}
    text = found["conversion"].content
    assert text == "Head\nOne two three\nfour <five>\nlink"
    assert "title: A &amp; B\r\nlanguage: de\r\nlinks: 1\r\n" in found["metadata"].content
    response = warc.responses(pages(spark, [(1, "http://a/", PAGE)])).first()
    for kind, r in found.items():
        assert r.refers_to == response.record_id and r.record_id != response.record_id
        assert r.source_digest == "sha256:" + hashlib.sha256(PAGE.encode()).hexdigest()
        assert r.block_digest == "sha256:" + hashlib.sha256(r.content.encode()).hexdigest()
        assert r.content_length == len(r.content.encode()) and r.source_headers.startswith("HTTP/1.1 200 OK\r\n")
    assert len({r.record_id for r in found.values()}) == 2


def test_files_hold_whole_records(spark, tmp_path):
    import gzip
    records = warc.build(pages(spark, [(1, "http://a/", PAGE), (2, None, None), (3, "http://b/", "é\n\nü")]))
    warc.write(records.coalesce(1), str(tmp_path / "w"))
    raw = b"".join(gzip.open(p).read() for p in sorted((tmp_path / "w").glob("*.gz")))
    seen, at = {}, 0
    while at < len(raw):
        head, _, rest = raw[at:].partition(b"\r\n\r\n")
        fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
        size = int(fields["Content-Length"])
        assert rest[size:size + 4] == b"\r\n\r\n"
        seen[fields["WARC-Record-ID"]] = rest[:size].decode()
        at += len(head) + 4 + size + 4
    assert seen == {r.record_id: r.content for r in records.collect()}


def test_warc_takes_awkward_rows(spark):
    rows = [(None, None, None), (1, "", ""), (2, "u", PAGE), (2, "u", PAGE), (3, "u", "<p>" + "x " * 100_000)]
    made = pages(spark, rows).selectExpr("*", "'x' AS content", "'y' AS record_id", "'z' AS target", "'q' AS _text")
    found = warc.build(made)
    assert found.count() == 2 * len(rows)
    assert found.where("record_id IS NULL OR content IS NULL OR block_digest IS NULL").count() == 0
    assert warc.build(made.limit(0)).count() == 0


@pytest.mark.parametrize("piece", ["<!-- ", "<script ", "<", "<title>", "<title ", "<html ", "<a ", "</script ", "<br ", "<p ", "-", " \t", "&lt;"])
def test_pages_full_of_openers_are_linear(spark, piece):
    page = "<p>before</p>" + piece * (1_000_000 // len(piece))
    begin = time.time()
    found = {r.record_type: r for r in warc.build(pages(spark, [(1, "http://a/", page)])).collect()}
    assert time.time() - begin < 20 and found["conversion"].content.startswith("before")


def test_rare_entries_are_not_crowded_out(spark):
    """Far more common entries than any fixed list of candidates would hold."""
    common = " ".join(f"w{i:05d}" for i in range(22_000))
    rows = [(f"{common} zorgle", 1)] * 5 + [(common, 1)] * 3 + [(common, 0)] * 12 + [(prose(i), 0) for i in range(20)]
    learned = toxicity.learned(spark.createDataFrame(rows, "text string, toxic int").repartition(4))
    assert any("zorgle".startswith(e.lstrip("=")) and len(e) > 2 for e in learned)


def test_many_languages_are_learned(spark):
    rows = [(i, " ".join(f"{chr(0x4E00 + i % 230)}{chr(0x3041 + k)}" for k in range(30)), f"l{i % 230:03d}") for i in range(460)]
    model = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert set(model.languages) == {f"l{i:03d}" for i in range(230)}
