"""What operators must not leave out."""

import random
import string
import textwrap

import numpy as np

import corpus_pipeline
from sportmart.llm import language_id, license_scan
from tests.llm import data


def spoken(seed, letters, n):
    """Words of one alphabet."""
    r = random.Random(seed)
    return " ".join("".join(r.choice(letters) for _ in range(r.randint(2, 6))) for _ in range(n))


def test_language_id_learns_from_long_texts(spark):
    """One language has texts of over 4096 bytes alone, with characters of two bytes that a stretch can cut."""
    rows = [(i, spoken(i, "éßouä", 2000), "long", "s", 1) for i in range(40)]
    rows += [(i, spoken(i, "theansr", 30), "short", "s", 1) for i in range(40, 80)]
    docs = data.frame(spark, rows)
    taken = language_id.training_rows(docs).collect()
    assert {r["label"] for r in taken} == {"long", "short"}
    assert all(0 < len(r["text"]) <= language_id.TRAINING_BYTES for r in taken)
    stretches = {bytes(r["text"]) for r in taken if r["label"] == "long"}
    whole = [t.encode() for _, t, label, _, _ in rows if label == "long"]
    assert all(any(s in t for t in whole) for s in stretches)
    # Drawn from all over the texts, not from their heads.
    assert not all(any(t.startswith(s) for t in whole) for s in stretches)
    got = {r["doc_id"]: r["lang_pred"] for r in language_id.identified(docs).collect()}
    assert got == {i: label for i, _, label, _, _ in rows}


def test_language_id_learns_where_all_texts_are_long(spark):
    docs = data.frame(spark, [(i, spoken(i, "theansr", 3000), "en", "s", 1) for i in range(20)])
    assert {r["lang_pred"] for r in language_id.identified(docs).collect()} == {"en"}


def test_pipeline_drops_texts_of_no_learned_language(spark):
    r = random.Random(1)
    strange = {
        -1: "Это предложение написано на русском языке и не должно остаться.", -2: "Αυτή είναι μια πρόταση στα ελληνικά.",
        -3: "".join(r.choice(string.ascii_letters + string.digits + string.punctuation) for _ in range(300)),
        -4: "static int f(struct node *p, size_t n) { for (int i = 0; i < n; ++i) p->next[i] &= ~0xFFu; return !p; }",
        -5: "这是一个用中文写的句子。今天天气很好，我们去公园散步。",
    }
    clean = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    rows = [(i, t, None, "s", len(t)) for i, t in strange.items()]
    docs = clean.unionByName(spark.createDataFrame(rows, data.SCHEMA), allowMissingColumns=True)
    kept = {r["doc_id"] for r in corpus_pipeline.identify_language(spark, docs, "").collect()}
    assert not kept & strange.keys()
    assert len(kept) >= 0.99 * clean.count()


def test_code_length_left_out_is_that_of_the_other_texts():
    texts = {"a": [b"abracadabra", b"abba", b"abra"], "b": [b"bonobo", b"boa"]}

    def model(own):
        counts = {}
        for order in range(language_id.ORDER + 1):
            found = []
            for language, of_one in enumerate(own.values()):
                raw, at, _ = language_id.padded(of_one)
                keys, times = np.unique(language_id.grams(raw, at, order), return_counts=True)
                found.append((keys, np.full(len(keys), language), times.astype(float)))
            counts[order] = tuple(map(np.concatenate, zip(*found)))
        return language_id.Model(list(own), counts)

    whole = model(texts)
    for k, text in enumerate(texts["a"]):
        others = model({**texts, "a": [t for j, t in enumerate(texts["a"]) if j != k]})
        assert np.isclose(whole.bits_left_out(0, text), others.bits([text])[0, 0])


def test_license_notices_of_many_lines(spark):
    """Every notice wrapped at 30 columns, with a blank line behind each, and as a comment, between lines of prose."""
    rows, want = [], {}
    for k, (label, template) in enumerate(license_scan.TEMPLATES):
        lines = textwrap.wrap(template, 30)
        forms = ("\n".join(lines), "\n\n".join(lines), "\n".join(" * " + x for x in lines), "\n".join(template.split()))
        for j, form in enumerate(forms):
            rows.append((10 * k + j, f"{data.prose(k, 40)}\n{form}\n{data.prose(k + 50, 40)}", "en", "s", 1))
            want[10 * k + j] = label
        # The same words, but far from one another.
        rows.append((10 * k + 9, "\n".join(f"{w}\n{data.prose(j, 60)}" for j, w in enumerate(template.split())), "en", "s", 1))
        want[10 * k + 9] = ""
    got = {r["doc_id"]: r for r in license_scan.scan_documents(data.frame(spark, rows)).collect()}
    assert all(want[i] in got[i]["labels"].split(",") for i in want), {i: got[i]["labels"] for i in want}
    assert all(got[i]["score"] == 1.0 for i in want if want[i])
