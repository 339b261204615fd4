"""Operators with trained models and the templates: held-out accuracy, planted cases, defined edge cases."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from fulluse.llm import decontaminate, language, quality
from fulluse.llm.common import Scratch
from tests.llm.conftest import SF

LARGER = "/root/testdata/sf0.01"


def test_quality_on_rows_it_did_not_see(spark):
    docs = spark.read.parquet(f"{LARGER}/documents.parquet")
    labels = spark.read.parquet(f"{LARGER}/labels.parquet")
    held = labels.filter(F.pmod(F.xxhash64("doc_id"), 3) == 0)
    model = quality.train(docs, labels.join(held, "doc_id", "left_anti"))
    found = quality.score(docs, model).join(held, "doc_id").select("quality", "kept", "p_content", "p_metadata").collect()
    good = [r for r in found if r["quality"] == 1]
    bad = [r for r in found if r["quality"] == 0]
    assert sum(r["kept"] for r in good) / len(good) > 0.98
    assert sum(not r["kept"] for r in bad) / len(bad) > 0.7


def test_quality_teaches_across_views():
    rng = np.random.default_rng(1)
    y = (rng.random(60) < 0.6).astype(float)
    pool_y = (rng.random(600) < 0.6).astype(float)

    def view(labels):
        return (rng.normal(size=(len(labels), 12)) + np.outer(2 * labels - 1, np.linspace(0.2, 1.2, 12))).astype(np.float32)

    apart = np.arange(60) % 4 == 0
    model = quality.co_train(view(y), view(y), y, apart, view(pool_y), view(pool_y))
    test_y = (rng.random(500) < 0.6).astype(float)
    p = model.scores(view(test_y), view(test_y))
    assert ((p[:, 2] > 0.5) == test_y).mean() > 0.95
    assert np.isfinite(p).all()


def test_quality_edges(spark, docs):
    none = spark.createDataFrame([], "doc_id long, quality int")
    model = quality.train(docs, none)
    assert model is None
    found = quality.score(docs, model)
    assert found.count() == docs.count() and found.filter("kept").count() == docs.count()
    labels = spark.createDataFrame([(k, k % 2) for k in range(60)] + [(None, 1), (3, None), (999, 1)], "doc_id long, quality int")
    model = quality.train(docs, labels)
    clashing = docs.withColumn("kept", F.lit("x")).withColumn("p_content", F.lit("y"))
    assert quality.score(clashing, model).count() == docs.count()
    assert quality.score(docs.limit(0), model).count() == 0
    bare = docs.select("doc_id", "text")
    assert quality.score(bare, model).filter("quality_score is null").count() == 0


def test_language_on_known_rows(spark):
    docs = spark.read.parquet(f"{LARGER}/documents.parquet").filter("length(text) > 200")
    known = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0
    model = language.fit(docs.filter(known))
    rest = docs.filter(~known)
    found = language.identify(language.from_documents(rest), model, Scratch(spark), "d")
    right = found.join(rest.select(F.col("doc_id").alias("id"), F.col("lang").alias("want")), "id")
    assert right.filter("lang = want").count() / right.count() > 0.97
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    found = language.identify(language.from_pages(pages), model, Scratch(spark), "p").collect()
    assert len(found) == pages.count()
    declared = {r["id"]: r["declared"] for r in language.from_pages(pages).select("id", "declared").collect()}
    assert sum(r["lang"] == declared[r["id"]] for r in found) / len(found) > 0.9


def test_language_fuses_evidence(spark):
    """A text that says nothing takes the language its host has; a host without rows of its own that of its domain."""
    docs = spark.createDataFrame([(k, t, g) for k, (t, g) in enumerate([("the and of with that", "en"), ("der und die nicht mit", "de")] * 20)], "doc_id long, text string, lang string")
    model = language.fit(docs)
    pages = [(k, f"http://a.site.de/{k}", "<html lang='de'><p>der und die nicht mit " * 9) for k in range(30)]
    pages += [(k, f"http://b.other.com/{k}", "<html lang=en><p>the and of with that " * 9) for k in range(30, 60)]
    pages += [(60, "http://a.site.de/x", None), (61, "http://new.site.de/", "<html>"), (62, None, ""), (None, "no url", "<html lang='??'>")]
    table = spark.createDataFrame(pages, "page_id long, url string, html string")
    found = {r["id"]: r for r in language.identify(language.from_pages(table), model, Scratch(spark), "f").collect()}
    assert len(found) == len(pages)
    assert {found[k]["lang"] for k in (*range(30), 60, 61)} == {"de"}
    assert {found[k]["lang"] for k in range(30, 60)} == {"en"}
    assert found[60]["text_lang"] is None and 0 < found[62]["confidence"] <= 1
    assert language.identify(language.from_pages(table.limit(0)), model, Scratch(spark), "e").count() == 0
    nothing = language.fit(docs.limit(0))
    assert language.identify(language.from_pages(table), nothing, Scratch(spark), "n").filter("lang is null").count() == len(pages)


ITEM = "A train leaves the station in Paris at 40 km per hour and meets another train from Paris after 3 hours of travel"
OTHER = "A train leaves the station in Rome at 55 km per hour and meets another train from Rome after 7 hours of travel"
MIXED = "A train leaves the station in Rome at 55 km per hour and meets another train from Oslo after 7 hours of travel"


@pytest.mark.parametrize("text,hit,changed", [
    (f"Some words before. {ITEM} and after.", True, False),
    (f"Some words before. {ITEM.upper()}", True, False),
    (f"words {OTHER} after", True, True),
    (f"words {MIXED} after", False, False),
    ("the station in Paris at 40 km per hour", False, False),
    (None, False, False), ("", False, False),
])
def test_templates(spark, scratch, text, hit, changed):
    docs = spark.createDataFrame([(5, text), (None, text), (6, "nothing here")], "doc_id long, text string")
    items = spark.createDataFrame([(1, ITEM), (2, "short item"), (3, None), (1, ITEM)], "item_id long, text string")
    found = decontaminate.matches(docs, items, scratch).collect()
    assert {r["doc_id"] for r in found} == ({5, None} if hit else set())
    assert all(r["item_id"] == 1 and r["reparameterised"] == changed for r in found)
    clean = decontaminate.clean_rows(docs, items, scratch)
    assert clean.columns == docs.columns and clean.count() == (1 if hit else 3)


def test_template_windows_against_brute_force(spark, scratch):
    """Every item that stands whole in a document is found, and nothing in documents that share no long run of words."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    found = {(r["doc_id"], r["item_id"]) for r in decontaminate.matches(docs, items, scratch).collect()}
    want, near = set(), set()
    wanted = {r["item_id"]: r["text"].lower().split() for r in items.collect()}
    for r in docs.collect():
        text = " " + " ".join((r["text"] or "").lower().split()) + " "
        for item, words in wanted.items():
            if f" {' '.join(words)} " in text:
                want.add((r["doc_id"], item))
            if any(f" {' '.join(words[k : k + 8])} " in text for k in range(len(words) - 7)):
                near.add((r["doc_id"], item))
    assert want <= found <= near and want
    plan = decontaminate.matches(docs, items, scratch)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_templates_of_nothing(spark, scratch):
    none, items = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([], "item_id long, text string")
    docs = spark.createDataFrame([(1, ITEM)], "doc_id long, text string")
    assert decontaminate.matches(none, items, scratch).count() == 0
    assert decontaminate.matches(docs, items, scratch).count() == 0
    assert decontaminate.clean_rows(docs, items, scratch).count() == 1


def leaks(spark, scratch, text, *items):
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    table = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    return decontaminate.matches(docs, table, scratch).collect()


@pytest.mark.parametrize("text", [ITEM.upper(), ITEM.lower(), OTHER.upper().replace("ROME", "PARIS")])
def test_items_in_other_case(spark, scratch, text):
    assert len(leaks(spark, scratch, f"Some words before. {text}", ITEM)) == 1


PLANET = "What is the largest planet that orbits around the sun?"
APPLES = "Tom has 3 red apples and buys 4 more apples at the market"


@pytest.mark.parametrize("text,item", [
    (f"Question: {PLANET}", PLANET), (f"A heading\n{PLANET}", PLANET), (PLANET.replace("What", "Which"), PLANET),
    (APPLES.replace("Tom", "Ann").replace("3", "5").replace("4", "9"), APPLES),
    ("So " + APPLES.replace("Tom", "Ann").replace("3", "5"), APPLES),
])
def test_first_words(spark, scratch, text, item):
    assert len(leaks(spark, scratch, text, item)) == 1


SUM = "What is 3 + 4?"
NUMBERS = "List: 2, 3, 5, 7, 11, 13, 17, 19, 23"
PEOPLE = "We met Anna, Bob, Carl, Dora, Emil, Fritz and Greta, 9 times"


@pytest.mark.parametrize("text,item,hit", [
    (f"Now say: {SUM} Well.", SUM, True), ("Now say: what is 3 * 4?", SUM, False), ("What is 3 + 5?", SUM, False),
    (f"Before. {NUMBERS}, and more", NUMBERS, True), (NUMBERS.replace("7", "8"), NUMBERS, False),
    (f"Before. {PEOPLE}, and more", PEOPLE, True), ("name one red fruit", "Name one red fruit now", False),
    ("so name one red fruit now and", "Name one red fruit now", True), ("... a", "...", False),
])
def test_short_and_dense_items(spark, scratch, text, item, hit):
    assert len(leaks(spark, scratch, text, item)) == hit


LONG = f"{ITEM}, while a second driver in Paris waits for the mail and reads about the weather of the coming week in a newspaper"


@pytest.mark.parametrize("text,item", [
    (APPLES.replace("3", "5").replace("4", "5"), APPLES),  # two values become one
    (LONG.replace("driver in Paris", "driver in Oslo"), LONG),  # one of three mentions edited
    (LONG.replace("40", "3"), LONG),  # one value becomes another of the item's
])
def test_edited_copies(spark, scratch, text, item):
    assert len(leaks(spark, scratch, text, item)) == 1


def test_words_are_read_once(spark):
    """op10_decontaminate: a word is read once for each reading, not once for each window that it is in."""
    rows = spark.createDataFrame([(1, 1, ITEM.split()), (2, 2, ["a"])], "doc_id long, tag long, words array<string>")
    items = rows.select(F.col("doc_id").alias("item_id"), "words")
    found = decontaminate.hashed(rows, [1, 3], decontaminate.sieve(items), "doc_id", "tag")
    words = ITEM.split()
    want = {(1, k, n) for n in (1, 3, 8) for k in range(len(words) - n + 1)} | {(2, 0, 1)}
    whole = {(r["doc_id"], r["at"], n): r["h"] for n in (1, 3, 8) for r in rows.select(
        "doc_id", F.posexplode(F.filter(F.transform("words", lambda w, k: F.slice("words", k + 1, n)), lambda s: F.size(s) == n)).alias("at", "s")
    ).select("doc_id", "at", decontaminate.run_hash(F.col("s"), n).alias("h")).collect()}
    assert set(whole) == want
    assert {(r["doc_id"], r["at"], r["h"]) for r in found.collect()} == {(d, at, h) for (d, at, _), h in whole.items()}
    assert found._jdf.queryExecution().optimizedPlan().toString().count("regexp_replace(") <= 40


def test_long_monotonous_texts(spark, scratch):
    """A megabyte of numbers, capitals, signs or marks takes no stack, and an item behind it is found."""
    texts = [part * 200_000 + f" . {ITEM}" for part in ("1,", "1.5 ", "A", "Aa ", "+", "3 + ", "‹›", ",.", "$ ")]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    items = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    assert {r["doc_id"] for r in decontaminate.matches(docs, items, scratch).collect()} == set(range(len(texts)))


def test_whole_rows_do_not_travel_to_be_scored(spark, docs):
    """Python is sent what the views read and sends scores back, also when a filter on them follows."""
    labels = spark.createDataFrame([(k, k % 2) for k in range(60)], "doc_id long, quality int")
    found = quality.score(docs, quality.train(docs, labels)).filter("kept").select(*docs.columns)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" not in plan and plan.count("ArrowEvalPython") == 1
    assert found.columns == docs.columns and found.count() <= docs.count()
