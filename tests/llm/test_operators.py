"""Operators against brute force on small documents."""

import hashlib
import math

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sportmart.llm import (
    decontamination, language_id, license_scan, line_dedup, quality_rules, sentencepiece_bpe, sharding, simhash,
    substring_dedup, token_counts,
)
from tests.llm import brute, data

PIECES = public_tokenizers.path("piece_bpe_32k.model")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
LABELS = "doc_id long, quality int, toxic int"
ITEMS = "item_id long, text string"


@pytest.fixture(scope="module")
def docs(spark):
    return data.frame(spark).cache()


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_quality_base(spark, docs):
    got = by_id(quality_rules.quality_documents(docs, spark.createDataFrame([], LABELS)))
    for i, text in data.texts().items():
        want = brute.base_counts(text)
        assert {k: got[i][k] for k in want} == want, i
        assert got[i]["kept"] == (not want["base_failed"])


def test_quality_cutoffs_hold_their_promise(spark):
    """Bad documents are full of symbols; one good one in 400 is too."""
    good, bad = data.prose(1, 40), "*** ".join(data.prose(2, 40).split(" "))
    rows = [(i, bad if i % 2 or i % 400 == 0 else good, "en" if i < 4000 else "fr", "s", 1) for i in range(4100)]
    labels = spark.createDataFrame([(i, int(i % 2 == 0), 0) for i in range(4100)], LABELS)
    got = quality_rules.judged(spark.createDataFrame(rows, data.SCHEMA), labels).toPandas().set_index("doc_id")
    en, fr = got[got.stratum == "en"], got[got.stratum == "fr"]
    assert en.cut_symbols.notna().all() and not en.kept[en.index % 2 == 1].any()
    assert (~en.kept[en.index % 2 == 0]).mean() <= quality_rules.RISK
    # 50 labels prove nothing, so nothing is rejected there.
    assert fr.cut_symbols.isna().all() and fr.kept.all()


def test_line_dedup(docs):
    got = by_id(line_dedup.dedup_lines(docs))
    want = brute.line_dedup(list(data.texts().items()))
    assert {i: r["text"] for i, r in got.items()} == want
    assert all(got[i]["source"] == f"src{i % 2}" and got[i]["key"] == "own key" for i in want)
    assert any(r["n_removed"] for r in got.values())


@pytest.mark.parametrize("mean", [2, 3])
def test_line_dedup_by_fewer_chunks(docs, mean):
    got = by_id(line_dedup.dedup_lines(docs, mean=mean))
    assert {i: r["text"] for i, r in got.items()} == brute.line_dedup(list(data.texts().items()), mean)


def test_line_dedup_finds_planted_passages_at_every_offset(spark):
    """Passages of two to six lines and over 50 words between other lines, blank ones too, in documents of their own."""
    rows, want, n = [], {}, 0
    for lines in range(2, 7):
        passage = [data.prose(300 + 10 * lines + k, 52 // lines + 1).replace("\n", " ") for k in range(lines)]
        for before in range(6):
            own = [data.prose(1000 + 50 * n + k, 12).replace("\n", " ") for k in range(before + 3)]
            held = passage if n % 2 else "\n\n \n".join(passage).split("\n")
            rows.append((n, "\n".join([*own[:before], *held, *own[before:]]), "en", "s", 1))
            want[n] = "\n".join(own) if before else rows[-1][1]
            n += 1
    got = {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(data.frame(spark, rows)).collect()}
    assert got == want


def test_line_dedup_leaves_no_shared_passage(spark):
    """Runs found on their own, by neighbouring lines of other documents, no exact copies: all their lines go."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    runs = brute.shared_runs([tuple(r) for r in docs.collect()])
    left = {r["doc_id"]: (r["text"] or "").split("\n") for r in line_dedup.dedup_lines(docs).collect()}
    assert len(runs) >= 10
    for doc_id, run in runs:
        assert not any(left[doc_id][k : k + len(run)] == run for k in range(len(left[doc_id])))
        assert sum(line in left[doc_id] for line in run if brute.words(line)) <= 0.1 * len(run), run


def test_sentencepiece(docs):
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    coded = sentencepiece_bpe.round_trip(PIECES)
    got = by_id(docs.select("doc_id", coded("text").alias("c")).select("doc_id", "c.ids", "c.text", *sentencepiece_bpe.digests(F.col("c"))))
    for i, text in data.texts().items():
        ids = model.encode(text or "", add_eos=True)
        assert (got[i]["ids"], got[i]["text"]) == (ids, model.decode(ids)), i
        assert got[i]["ids_sha256"] == sha(" ".join(map(str, ids))) and got[i]["n_tokens"] == len(ids)


def test_token_counts(docs):
    tokenizer = Tokenizer.from_file(BYTES)
    got = by_id(token_counts.counted_documents(docs, BYTES, public_tokenizers.PATTERN))
    for i, text in data.texts().items():
        n = len(tokenizer.encode(text or "", add_special_tokens=False).ids)
        assert (got[i]["n_tokens"], got[i]["n_bytes"], got[i]["over_limit"]) == (n, len((text or "").encode()), n > 1024), i


def test_simhash(docs):
    got = by_id(simhash.linked_documents(docs))
    prints = [(i, brute.fingerprint(t)) for i, t in data.texts().items()]
    assert {i: int(r["fingerprint"], 16) for i, r in got.items()} == dict(prints)
    want = brute.components(prints)
    assert {i: r["component_id"] for i, r in got.items()} == {i: want[(i, p)] for i, p in prints}
    kept = [r["doc_id"] for r in simhash.one_of_each(docs).collect()]
    assert sorted(kept) == sorted(set(want.values()))


def test_license_scan(docs):
    got = by_id(license_scan.scan_documents(docs))
    for i, text in data.texts().items():
        want = brute.license_scan(text, license_scan.TEMPLATES)
        assert {k: got[i][k] for k in want} == want, i
    assert got[42]["labels"] == "mit" and got[43]["labels"] == "gpl-3" and got[41]["n_base"] == 3


def test_license_blocks_meet_every_threshold(docs):
    templates = [("a", "the an on er ti"), ("b", "the ou re ing st an an"), ("c", "")]
    for threshold in (0.3, 0.6, 1.0):
        got = license_scan.matching_blocks(docs, templates, threshold, 1).collect()
        want = set()
        for i, text in data.texts().items():
            for k, line in enumerate((text or "").split("\n")):
                words = set(brute.license_words(line))
                for label, template in templates[:2]:
                    t = set(template.split())
                    if len(t & words) >= threshold * len(t) - 1e-9:
                        want.add((i, k, label, len(t & words) / len(t)))
        assert sorted((r["doc_id"], r["line"], r["label"], r["containment"]) for r in got) == sorted(want)


def test_license_windows_meet_every_threshold(docs):
    templates = [("a", "the an on er ti"), ("b", "the ou re ing st an an"), ("c", "")]
    for threshold in (0.3, 0.6, 1.0):
        got = license_scan.matching_windows(docs, templates, threshold).collect()
        want = {}
        for i, text in data.texts().items():
            w = brute.license_words(text)
            for label, template in templates[:2]:
                t, width = set(template.split()), math.ceil(len(template.split()) / threshold - 1e-9)
                best = max((len(t & set(w[k : k + width])) for k in range(len(w))), default=0)
                if best >= threshold * len(t) - 1e-9:
                    want[(i, label)] = best / len(t)
        assert {(r["doc_id"], r["label"]): r["containment"] for r in got} == want
    with pytest.raises(ValueError):
        license_scan.matching_windows(docs, templates, max_templates=2)


def test_sharding(docs):
    got = by_id(sharding.documents_sharded(docs))
    again = by_id(sharding.documents_sharded(docs.repartition(7)))
    assert got == again
    for i, text in data.texts().items():
        assert got[i]["size"] == len((text or "").encode()) + 8
        assert got[i]["text_crc32"] == (None if text is None else brute.crc(text))
    slots = {}
    for r in got.values():
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(len(slots.get(k, [])) for k in range(24)) <= 1


@pytest.mark.parametrize("common", [0, 2000])
def test_substring_dedup(docs, common):
    want = brute.substring_dedup(list(data.texts().items()))
    got = by_id(substring_dedup.dedup_substrings(docs, common=common, shard_words=500))
    assert {i: r["kept"] for i, r in got.items()} == {i: " ".join(w) for i, w in want.items()}
    assert all(got[i]["n_words"] == len(brute.words(t)) for i, t in data.texts().items())
    assert all(got[i]["n_removed"] == got[i]["n_words"] - len(want[i]) for i in want)


def test_substring_dedup_of_short_windows(docs):
    want = brute.substring_dedup(list(data.texts().items()), 7)
    got = by_id(substring_dedup.dedup_substrings(docs, window=7))
    assert {i: r["kept"] for i, r in got.items()} == {i: " ".join(w) for i, w in want.items()}


def test_decontamination_finds_reordered_items(spark):
    item, other = data.prose(20, 40).split(), data.prose(21, 30).split()
    moved = item[20:] + ["gap"] + item[:20]
    few = item[:20]
    rows = [
        (1, " ".join(["x"] * 9 + item + ["y"] * 9), None, None, None), (2, " ".join(moved).encode().upper().decode(), None, None, None),
        (3, " ".join(few), None, None, None), (4, data.prose(22, 200), None, None, None), (5, None, None, None, None),
        (6, "", None, None, None), (8, "these two  words here", None, None, None), (9, "words two", None, None, None), (7, "-- ".join(other) + " " + " ".join(item), None, None, None), (None, " ".join(item), None, None, None),
    ]
    items = spark.createDataFrame(
        [(1, " ".join(item)), (1, " ".join(item)), (2, " ".join(other)), (3, None), (4, "too short"), (5, "?!"), (6, "Two, words"), (None, " ".join(other))], ITEMS
    )
    docs = data.frame(spark, rows)
    found = decontamination.report(docs, items).collect()
    got = sorted((r["doc_id"] or 0, r["item_id"] or 0) for r in found)
    assert got == [(0, 1), (1, 1), (2, 1), (7, 0), (7, 1), (7, 2), (8, 6)]
    tiles = {r["doc_id"]: r["tiles"] for r in found if r["item_id"] == 1}
    assert tiles[1] == 1 and tiles[2] == 2
    left = decontamination.clean(docs, items)
    assert sorted(r["doc_id"] for r in left.collect()) == [3, 4, 5, 6, 9] and left.columns == docs.columns


def plain_report(docs, items):
    """All documents against all items: the tiling of whole texts, or the whole short item."""
    found = set()
    for doc_id, text in docs:
        words = brute.license_words(text)
        for item_id, item in items:
            own = brute.license_words(item)
            number = {w: k for k, w in enumerate(dict.fromkeys(own), 1)}
            code, rest = [number[w] for w in own], [number.get(w, 0) for w in words]
            marked = brute.tiling(code, rest, min(5, len(own))) if own else []
            if own and sum(marked) >= 0.8 * len(own):
                found.add((doc_id, item_id, sum(marked) / len(own), len(marked), max(marked)))
    return found


def test_decontamination_of_the_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    got = {tuple(r) for r in decontamination.report(docs, items).select("doc_id", "item_id", "coverage", "tiles", "longest").collect()}
    want = plain_report([(r["doc_id"], r["text"]) for r in docs.collect()], [(r["item_id"], r["text"]) for r in items.collect()])
    assert {x[:3] for x in got} == {x[:3] for x in want} and got


def test_decontamination_of_common_phrases_and_repetitive_texts(spark):
    """Items that share a phrase with many documents; texts of one word over and over, long ones too."""
    phrase = "once upon a time there was a king"
    items = [(k, f"{phrase} {data.prose(500 + k, 8)}") for k in range(12)] + [(50, "la " * 20), (51, phrase), (52, "la la la")]
    docs = [(k, f"{data.prose(600 + k, 30)} {phrase} {data.prose(700 + k, 30)}") for k in range(40)]
    docs += [(100 + k, f"x {items[k][1]} y") for k in range(3)] + [(200, "la " * 20_000), (201, "la la"), (202, "la " * 17 + "end")]
    docs += [(203, " ".join(items[4][1].split()[8:] + items[4][1].split()[:8]))]
    df = data.frame(spark, [(i, t, None, None, None) for i, t in docs])
    got = {tuple(r) for r in decontamination.report(df, spark.createDataFrame(items, ITEMS)).collect()}
    small = [(i, t[:3000]) for i, t in docs]
    assert {(a, b) for a, b, *_ in got} == {(a, b) for a, b, *_ in plain_report(small, items)}


def test_language_id_is_right_on_held_out_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    told = language_id.identified(docs).join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    held = told[told.held_out]
    assert len(held) > 200 and (held.lang == held.lang_pred).mean() > 0.98
    assert told.score.between(0, 1).all()


def test_language_id_of_odd_texts(docs):
    got = by_id(language_id.identified(docs))
    assert all(got[i]["lang_pred"] == "und" for i in (9, 10, 11, 50)) and got[5]["lang_pred"] in ("en", "fr")
    assert not got[9]["score"]


EMPTY = {
    "quality": lambda s, d: quality_rules.quality_documents(d, s.createDataFrame([], LABELS)),
    "decontamination": lambda s, d: decontamination.report(d, s.createDataFrame([], ITEMS)),
    "clean": lambda s, d: decontamination.clean(d, s.createDataFrame([], ITEMS)),
    "lines": lambda s, d: line_dedup.dedup_lines(d),
    "pieces": lambda s, d: d.select(sentencepiece_bpe.round_trip(PIECES)("text")),
    "simhash": lambda s, d: simhash.linked_documents(d),
    "heads": lambda s, d: simhash.one_of_each(d),
    "language": lambda s, d: language_id.identified(d),
    "tokens": lambda s, d: token_counts.counted_documents(d, BYTES, public_tokenizers.PATTERN),
    "license": lambda s, d: license_scan.scan_documents(d),
    "shards": lambda s, d: sharding.documents_sharded(d),
    "substrings": lambda s, d: substring_dedup.dedup_substrings(d),
}


@pytest.mark.parametrize("name", sorted(EMPTY))
def test_empty_tables(spark, name):
    assert EMPTY[name](spark, data.frame(spark, [])).collect() == []


@pytest.mark.parametrize("name", sorted(set(EMPTY) - {"decontamination", "heads"}))
def test_rows_without_id_and_repeated_rows_stay(spark, name):
    rows = data.awkward()
    assert len(EMPTY[name](spark, data.frame(spark, rows)).collect()) == len(rows)


def test_what_awkward_rows_lose(spark):
    docs = data.frame(spark, data.awkward())
    n = {}
    for r in substring_dedup.dedup_substrings(docs).collect():
        n.setdefault(r["doc_id"], []).append(r["n_removed"])
    # Rows of one id take nothing from each other; a row without id comes behind all others.
    assert n[1] == [0, 0, 0] and n[2] == [120] and n[3] == [80] and sorted(n[None]) == [0, 120, 120]
    kept = sorted((r["doc_id"] or 0, r["n_removed"] > 0) for r in line_dedup.dedup_lines(docs).collect())
    assert [x for x in kept if x[0] == 1] == [(1, False)] * 3 and (0, True) in kept
    heads = [r["doc_id"] for r in simhash.one_of_each(docs).collect()]
    assert sorted(x or 0 for x in heads) == [1, 1, 4]
