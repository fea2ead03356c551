"""Parts of the operators: codes, indexes, tilings, permutations, bounds."""

import math
import random
import time
from itertools import combinations

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sportmart.llm import golay, language_id, quality_rules, rolling, sharding, simhash
from sportmart.llm.common import BATCH_BYTES, BATCH_ROWS, importable
from sportmart.llm.components import components
from sportmart.llm.decontamination import tiles
from sportmart.llm.fm_index import FmIndex
from sportmart.llm.sentencepiece_bpe import Encoder
from tests.llm import brute

PIECES = public_tokenizers.path("piece_bpe_32k.model")


def test_golay_code_is_perfect():
    r = random.Random(1)
    index = np.array([r.randrange(4096) for _ in range(50)])
    words = np.array([(i << 11) | golay.remainder(int(i) << 11) for i in index])
    for n in range(4):
        for bits in list(combinations(range(23), n))[:: 1 + n * 40]:
            assert (golay.decode(words ^ sum(1 << b for b in bits)) == index).all()
    assert (np.bincount(golay.decode(np.arange(1 << 23)), minlength=4096) == 2048).all()


def test_near_indices_meet():
    values = np.random.default_rng(2).integers(0, 1 << 23, 400)
    near = golay.near_indices(values)
    assert ((near >= 0).sum(axis=1) <= 6).all()
    for bit in range(23):
        other = golay.decode(values ^ (1 << bit))
        assert (near == other[:, None]).any(axis=1).all()


def test_links_connect_all_prints_within_three_bits(spark):
    r = random.Random(3)
    prints = set()
    for _ in range(40):
        center = r.getrandbits(64)
        for _ in range(r.choice((2, 5, 60))):
            prints.add(center ^ sum(1 << b for b in r.sample(range(64), r.randint(0, 4))))
    prints = sorted(prints | {r.getrandbits(64) for _ in range(300)} | {0, 1, 3, 7, 15, 2**64 - 1})
    signed = np.array(prints, np.uint64).astype(np.int64).tolist()
    for bits in (0, 1, 3):
        links = simhash.linked_prints(spark.createDataFrame([(p,) for p in signed], "print long"), bits)
        root = {row["node"]: row["root"] for row in components(links).collect()}
        want = brute.components([(p, p) for p in prints], bits)
        got = {}
        for p, s in zip(prints, signed):
            got.setdefault(root.get(s, s), set()).add(p)
        expected = {}
        for p in prints:
            expected.setdefault(want[p, p], set()).add(p)
        assert sorted(map(sorted, got.values())) == sorted(map(sorted, expected.values()))


def test_crowded_buckets_are_dealt_out_in_blocks(spark):
    r = random.Random(5)
    center = r.getrandbits(64)
    near = {center ^ sum(1 << b for b in r.sample(range(64), r.randint(0, 5))) for _ in range(150)}
    # Steps of three bits: links that pass through members of different blocks.
    chain = {center ^ sum(1 << b for b in range(3 * k)) for k in range(8)}
    prints = sorted(near | chain | {r.getrandbits(64) for _ in range(40)})
    signed = np.array(prints, np.uint64).astype(np.int64).tolist()
    want = {frozenset(p) for p in groups_of(brute.components([(p, p) for p in prints]))}
    batch = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(batch)
    spark.conf.set(batch, 7)
    try:
        frame = spark.createDataFrame([(p,) for p in signed], "print long")
        for large in (3, 10, 1000):
            root = {row["node"]: row["root"] for row in components(simhash.linked_prints(frame, large=large)).collect()}
            assert {frozenset(p) for p in groups_of({(p, p): root.get(s, s) for p, s in zip(prints, signed)})} == want
    finally:
        spark.conf.set(batch, before)


def groups_of(root):
    groups = {}
    for (p, _), at in root.items():
        groups.setdefault(at, set()).add(p)
    return groups.values()


def test_crowded_buckets_are_counted():
    def batch(keys):
        return pa.RecordBatch.from_pydict({"key": keys, "print": list(range(len(keys))), "own": [True] * len(keys)})

    out = list(simhash.links_of_buckets(0, 3)(iter([batch([1, 2]), batch([2, 2]), batch([2, 2]), batch([]), batch([2, 3, 3])])))
    rows = [(r["a"], r["n"]) for b in out for r in b.to_pylist()]
    assert rows == [(2, 6)]
    out = list(simhash.links_of_buckets(0, 3)(iter([batch([2, 2]), batch([2, 2, 2])])))
    assert [(r["a"], r["n"]) for b in out for r in b.to_pylist()] == [(2, 5)]


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(100)] + [(500, 600 + i) for i in range(50)] + [(900, 900)]
    random.Random(4).shuffle(edges)
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(1, 101)} | {600 + i: 500 for i in range(50)}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(1, 4), min_size=1, max_size=25), min_size=1, max_size=8), st.integers(1, 9))
def test_fm_index_matches_naively(texts, depth):
    flat, starts, ends = [], [], []
    for t in texts:
        starts.append(len(flat))
        flat += t
        ends.append(len(flat))
        flat.append(0)
    index = FmIndex(np.array(flat), depth)
    length, low, high = index.matching_statistics(np.array(flat), np.array(starts), np.array(ends))
    for s, e in zip(starts, ends):
        for i in range(s, e):
            # Every text is indexed itself, so it matches up to its end or the depth.
            assert length[i] == min(depth, e - i)
            if length[i] == depth:
                pattern = flat[i : i + depth]
                want = [j for j in range(len(flat)) if flat[j : j + depth] == pattern]
                assert sorted(index.suffixes[low[i] : high[i]].tolist()) == want


@settings(max_examples=60, deadline=None)
@given(
    st.lists(st.lists(st.integers(1, 4), min_size=1, max_size=20), min_size=1, max_size=5),
    st.lists(st.lists(st.integers(1, 6), min_size=1, max_size=20), min_size=1, max_size=4), st.integers(1, 7),
)
def test_fm_index_streams_foreign_texts(texts, foreign, depth):
    flat = [x for t in texts for x in [*t, 0]]
    index = FmIndex(np.array(flat), depth)
    stream = np.array([x for t in foreign for x in [*t, 0]])
    ends = np.cumsum([len(t) + 1 for t in foreign]) - 1
    starts = ends - [len(t) for t in foreign]
    length, low, high = index.matching_statistics(stream, starts, ends)
    held = {tuple(t[i : i + n]) for t in texts for n in range(1, depth + 1) for i in range(len(t) - n + 1)}
    for s, e in zip(starts, ends):
        for i in range(s, e):
            want = max([n for n in range(1, min(depth, e - i) + 1) if tuple(stream[i : i + n]) in held], default=0)
            assert length[i] == want
            if want == depth:
                pattern = stream[i : i + depth].tolist()
                places = [j for j in range(len(flat)) if flat[j : j + depth] == pattern]
                assert sorted(index.suffixes[low[i] : high[i]].tolist()) == places


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 3), max_size=30), st.lists(st.integers(1, 3), max_size=40), st.integers(1, 5), st.integers(1, 20))
def test_tiles_are_a_maximal_tiling(item, text, least, search):
    found = tiles(item, text, least, search)
    in_item, in_text = set(), set()
    for p, t, n in found:
        assert n >= least and item[p : p + n] == text[t : t + n]
        assert not in_item & set(range(p, p + n)) and not in_text & set(range(t, t + n))
        in_item |= set(range(p, p + n))
        in_text |= set(range(t, t + n))
    for p in range(len(item) - least + 1):
        for t in range(len(text) - least + 1):
            free = not in_item & set(range(p, p + least)) and not in_text & set(range(t, t + least))
            assert not (free and item[p : p + least] == text[t : t + least])


def test_longest_tile_goes_first():
    assert tiles([1, 2, 3, 4, 5, 6], [1, 2, 3, 9, 2, 3, 4, 5, 6, 9], 2)[0] == (1, 4, 5)


@pytest.fixture(scope="module")
def coders():
    return Encoder(PIECES), sentencepiece.SentencePieceProcessor(model_file=PIECES)


@settings(max_examples=300, deadline=None)
@given(text=st.text(alphabet=st.one_of(st.sampled_from("aabbcdehinorst  ▁\n.,é'"), st.characters(exclude_categories=["Cs"])), max_size=60))
def test_pieces_as_the_library_cuts_them(coders, text):
    own, library = coders
    ids = library.encode(text, add_eos=True)
    assert own.encode([text])[0].tolist() == ids and own.vocabulary.decode(ids) == library.decode(ids)


@settings(max_examples=200, deadline=None)
@given(ids=st.lists(st.one_of(st.integers(3, 258), st.integers(1, 31_999)), max_size=9))
def test_any_ids_decode_as_in_the_library(coders, ids):
    own, library = coders
    assert own.vocabulary.decode(np.array(ids, np.int64)) == library.decode(ids)


def test_pieces_of_joined_vocabulary_and_cache_reset(coders, monkeypatch):
    own, library = coders
    r = random.Random(5)
    pieces = [library.id_to_piece(i) for i in range(259, 32_000)]
    texts = ["".join(r.choice(pieces) for _ in range(r.randint(0, 12))).replace("▁", " ") for _ in range(3000)]
    monkeypatch.setattr("sportmart.llm.sentencepiece_bpe.CACHE_IDS", 2000)
    monkeypatch.setattr("sportmart.llm.sentencepiece_bpe.BLOCK", 500)
    assert [x.tolist() for x in own.encode(texts)] == library.encode(texts, add_eos=True)


def long_texts(n):
    r = random.Random(n)
    letters = "abcdefghijklmnopqrstuvwxyz"
    return {
        "blanks": " " * n, "letters": "".join(r.choice(letters) for _ in range(n)), "few": "".join(r.choice("aet") for _ in range(n)),
        "one": "a" * n, "equal": "=" * n, "pairs": "ab" * (n // 2), "threes": "the" * (n // 3), "sevens": "ing=the" * (n // 7),
        "mixed": "".join(r.choice([" " * r.randint(1, 40), "then", "-", "\n", "é", "日本", "😀"]) for _ in range(n // 8)),
        "lines": "\n" * n, "near": " " * (n // 2) + "x" + " " * (n // 2) + "yes",
    }


def test_long_words_as_the_library_cuts_them(coders):
    own, library = coders
    for n in (129, 200, 1003, 5000):
        for name, text in long_texts(n).items():
            assert own.encode([text])[0].tolist() == library.encode(text, add_eos=True), (name, n)


@settings(max_examples=150, deadline=None)
@given(text=st.text(alphabet=st.sampled_from("  ▁aabbeht=-."), min_size=130, max_size=700), times=st.integers(1, 4))
def test_repeated_texts_as_the_library_cuts_them(coders, text, times):
    own, library = coders
    assert own.encode([text * times])[0].tolist() == library.encode(text * times, add_eos=True)


def test_time_grows_with_the_text(coders):
    """Ten times the text takes about ten times as long, whatever the text."""
    own, library = coders
    for name in long_texts(10):
        took = []
        for n in (10_000, 100_000):
            text = long_texts(n)[name]
            own.forget()
            start = time.perf_counter()
            ids = own.encode([text])[0]
            took.append(time.perf_counter() - start)
            assert ids.tolist() == library.encode(text, add_eos=True)
        assert took[1] < 30 * took[0] + 0.5 and took[1] < 15, (name, took)


@pytest.mark.parametrize("n", [1, 2, 3, 7, 23, 97, 200, 1000, 1009])
def test_permutation(spark, n, monkeypatch):
    # Few tries leave surplus cells, so that the walk is walked.
    real = sharding.domain
    monkeypatch.setattr(sharding, "domain", lambda x: real(x, 1))
    rows = spark.range(n).select(sharding.shuffled(F.col("id"), n).alias("y")).collect()
    assert sorted(r["y"] for r in rows) == list(range(n))
    a, b = real(n)
    assert a * b - n >= 0


def test_equal_rows_get_numbers_of_their_own(spark):
    rows, n = sharding.numbered(spark.createDataFrame([(1,)] * 50 + [(None,)] * 20 + [(2,)], "k long"))
    got = rows.collect()
    assert n == 71 and sorted(r["row_number"] for r in got) == list(range(71))


def test_binomial_tail_is_exact(spark):
    cases = [(k, n, p) for n in (1, 5, 20, 21, 22, 300, 5000) for p in (0.01, 0.0125, 0.3) for k in range(0, min(n, 40), 3)]
    for p in (0.01, 0.0125, 0.3):
        own = [(k, n) for k, n, q in cases if q == p]
        df = spark.createDataFrame(own, "k long, n long").select("k", "n", quality_rules.binomial_tail(F.col("k"), F.col("n"), p).alias("t"))
        for r in df.collect():
            k, n = r["k"], r["n"]
            want = 1.0 if k >= n * p else sum(math.comb(n, j) * p**j * (1 - p) ** (n - j) for j in range(k + 1))
            assert math.isclose(r["t"], want, rel_tol=1e-9, abs_tol=1e-300), (k, n, p)


def test_copies_are_dealt_out_in_ranges_whatever_the_names(spark, monkeypatch):
    """Columns named like the helpers stay; rows that repeat are numbered range by range."""
    names = ["row", "digest", "copies", "bucket", "start", "end"]
    values = [(i % 3 or None, f"d{i % 3}", 1, "b", None, 2.0) for i in range(100)] + [(9, None, 2, "b", 3, 1.0)]
    rows = spark.createDataFrame(values, "`row` int, digest string, copies int, bucket string, `start` int, `end` double")
    whole = sharding.numbered(rows)[0].collect()
    monkeypatch.setattr(sharding, "RANGE", 7)
    dealt, n = sharding.numbered(rows)
    assert n == 101 and dealt.columns == [*names, "row_number"]
    got = dealt.collect()
    assert sorted(r["row_number"] for r in got) == list(range(101))
    assert sorted(map(str, got)) == sorted(map(str, whole))
    assert sorted(map(str, (tuple(r)[:-1] for r in got))) == sorted(map(str, values))


def test_languages_are_bounded_and_repeated_rows_learned_once(spark, monkeypatch):
    rows = [(i, f"text number {i} of some words", f"l{i % 9}") for i in range(900)] + [(1, "same row", "l1")] * 500
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    monkeypatch.setattr(language_id, "TRAINING_TEXTS", 4)
    taken = language_id.training_rows(docs).collect()
    assert len(taken) <= 4 and len({r["label"] for r in taken}) == len(taken)
    monkeypatch.setattr(language_id, "TRAINING_TEXTS", 3000)
    taken = [bytes(r["text"]) for r in language_id.training_rows(docs).collect()]
    assert len(taken) == len(set(taken)) > 600


def test_sparse_model_grows_with_what_a_language_has():
    """Fifty languages with alphabets of their own: each gram is stored once, not once a language."""
    rng = np.random.default_rng(3)
    counts = {order: ([], [], []) for order in range(language_id.ORDER + 1)}
    for language in range(50):
        raw, at, _ = language_id.padded([bytes((100 + language + rng.integers(0, 4, 4096)).astype(np.uint8))])
        for order, (gram, own, times) in counts.items():
            keys, n = np.unique(language_id.grams(raw, at, order), return_counts=True)
            gram.append(keys), own.append(np.full(len(keys), language)), times.append(n)
    counts = {order: tuple(map(np.concatenate, x)) for order, x in counts.items()}
    model = language_id.Model([str(i) for i in range(50)], counts)
    entries = sum(len(t.value) for tables in (model.by_gram, model.by_context) for t in tables.values())
    assert entries <= sum(2 * len(x[0]) for x in counts.values())
    assert model.nbytes() <= 18 * entries + 50 * 256 * 16 + 1000


def test_code_lengths_as_defined():
    texts = {"a": [b"abracadabra", b"abba"], "b": [b"bonobo", b"boa"]}
    counts = {}
    for order in range(language_id.ORDER + 1):
        rows = {}
        for l, own in enumerate(texts.values()):
            for t in own:
                raw, at, _ = language_id.padded([t])
                for g in language_id.grams(raw, at, order).tolist():
                    rows[(g, l)] = rows.get((g, l), 0) + 1
        keys = sorted(rows)
        counts[order] = (
            np.array([k[0] for k in keys], np.uint32), np.array([k[1] for k in keys]), np.array([rows[k] for k in keys], float)
        )
    model = language_id.Model(list(texts), counts)

    def naive(own, text):
        bits, padded = 0.0, language_id.PAD + text
        for i in range(language_id.ORDER, len(padded)):
            for order in range(language_id.ORDER, -2, -1):
                if order < 0:
                    bits += 8
                    break
                context = padded[i - order : i]
                after = [
                    t[j] for t in (language_id.PAD + x for x in own) for j in range(language_id.ORDER, len(t)) if t[j - order : j] == context
                ]
                kinds = len(set(after))
                if padded[i] in after:
                    bits -= math.log2(after.count(padded[i]) / (len(after) + kinds))
                    break
                if after:
                    bits -= math.log2(kinds / (len(after) + kinds))
        return bits

    asked = [b"abra", b"bonobo zz", b"", "é".encode(), b"cadabra" * 30]
    for t, got in zip(asked, language_id.code_lengths(model, asked)):
        assert np.allclose(got, [naive(own, t) for own in texts.values()]), t
    whole = model.bits([b"abracadabonobo" * 20])[0]
    language_id.BLOCK, size = 37, language_id.BLOCK
    try:
        assert np.allclose(model.long_bits(b"abracadabonobo" * 20), whole)
    finally:
        language_id.BLOCK = size


@settings(max_examples=100, deadline=None)
@given(st.lists(st.binary(max_size=40), max_size=6))
def test_blocks_hold_the_words(texts):
    found = [[] for _ in texts]
    for block in rolling.blocks(texts, rolling.WHITE):
        for s, e, t in zip(block.starts, block.ends, block.texts):
            found[t].append(block.raw[s:e])
    assert found == [t.split() for t in texts]


def test_long_texts_are_cut_alike(monkeypatch):
    text = (" ".join(f"w{i % 50}" for i in range(4000)) + " " + "y" * 70_000 + " w1 w2").encode()
    (whole,) = rolling.blocks([text], rolling.WHITE)
    assert [text[s:e] for s, e in zip(whole.starts, whole.ends)] == text.split()
    hashes = {}
    for w, h in zip(text.split(), whole.hashes.tolist()):
        assert hashes.setdefault(w, h) == h
    assert len(set(hashes.values())) == len(hashes)
    (short,) = rolling.blocks([b"w1 w2"], rolling.WHITE)
    assert short.hashes.tolist() == [hashes[b"w1"], hashes[b"w2"]]


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(0, 99), max_size=60), st.integers(1, 40))
def test_sliding_least(values, width):
    got = rolling.sliding_least(np.array(values, np.uint64), width)
    assert got.tolist() == [min(values[i : i + width]) for i in range(len(values) - width + 1)]


def test_fingerprints_as_defined():
    for text in ("", "a", "a b", "A b\tC d", "é É x y z " * 50):
        assert simhash.fingerprint(text.encode()) == brute.fingerprint(text)


def test_batches_of_long_texts_are_bounded_in_bytes(spark):
    importable(spark)

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], ["n"])

    texts = spark.range(0, 200, 1, 1).select(F.repeat(F.lit("x"), 100_000).alias("text"))
    rows = [r["n"] for r in texts.mapInArrow(sizes, "n long").collect()]
    assert sum(rows) == 200 and max(rows) <= 2 * BATCH_BYTES // 100_000
    assert int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= BATCH_ROWS
