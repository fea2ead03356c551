"""Conversation repair, embeddings and spelling variants against brute force on odd fixtures."""

import hashlib
import math
import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from sportmart.llm import conversation_repair, embedding_dedup, spelling_variants
from tests.llm import data

TURNS = "conv_id long, turn long, role string, text string"


# Conversations


def brute_damage(row):
    conv_id, turn, role, text = row
    word = lambda x: " " if x is None else str(x)
    lot = zlib.crc32(f"{word(conv_id)}:{word(turn)}".encode()) % 20
    role, text = word(role), word(text)
    if lot == 1:
        text = ""
    if lot == 2:
        text = "".join(c for c in text if c not in ".!?")
    if lot == 4:
        role = "user"
    return [(conv_id, turn, role, text)] * {0: 0, 3: 2}.get(lot, 1)


def brute_repair(turns):
    """The best ends of a conversation from the last turn to the first, up to two insertions before each, audits compared as text."""
    turns = sorted(turns, key=lambda t: (t[1] is not None, t[1] or 0, t[2], hashlib.sha256(t[3].encode()).hexdigest()))
    seen, faults = set(), []
    for _, _, role, text in turns:
        bare = text.strip(" \t\n\x0b\x0c\r")
        faults.append("b" if not bare else "d" if (role, text) in seen else "t" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    follows = {"": "su", "s": "u", "u": "a", "a": "u"}
    names = {"u": "user", "a": "assistant"}

    def insertions(ends):
        """Ends by the role before, with up to two turns inserted first."""
        for _ in range(2):
            ends = {
                q: min([ends[q]] + [
                    (ends[x][0] + 2, "I" + ends[x][1], (names[x] + ":", ends[x][2])) for x in follows[q] if x != "s"
                ])
                for q in ends
            }
        return ends

    never = (10**9, "", None)
    ends = insertions({"": (0, "", None), "s": never, "u": never, "a": (0, "", None)})
    for (_, _, role, text), fault in zip(reversed(turns), reversed(faults)):
        now = {}
        for q in ends:
            paths = [(ends[q][0] + 3, "D" + ends[q][1], ends[q][2])]
            if fault not in ("b", "d"):
                cut = fault == "t"
                for x in follows[q]:
                    if role[:1] == x:
                        paths.append((ends[x][0] + cut, "K" + ends[x][1], (f"{role}:{text}", ends[x][2])))
                    if x != "s":
                        paths.append((ends[x][0] + cut + 2, "R" + ends[x][1], (f"{names[x]}:{text}", ends[x][2])))
            now[q] = min(paths, key=lambda p: p[:2])
        ends = insertions(now)
    cost, audit, rest = ends[""]
    lines = []
    while rest:
        lines.append(rest[0])
        rest = rest[1]
    numbers = [t[1] for t in turns if t[1] is not None]
    initials = [t[2][:1] for t in turns]
    return (
        max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0, faults.count("b"), faults.count("d"),
        faults.count("t"), sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
        hashlib.sha256("\n".join(lines).encode()).hexdigest(),
    )


def brute_conversations(rows, damage=True):
    found = {r[0]: [] for r in rows}
    for r in rows:
        found[r[0]] += brute_damage(r) if damage else [(r[0], r[1], *(" " if x is None else x for x in r[2:]))]
    return {conv_id: brute_repair(turns) for conv_id, turns in found.items()}


def repaired(spark, rows, damage=True):
    df = spark.createDataFrame(rows, TURNS).repartition(5)
    df = df.withColumns({c: F.lit("own") for c in ("copies", "digest", "fault", "least", "head", "place", "audit")})
    if damage:
        df = conversation_repair.damaged(df)
    else:
        df = df.select("conv_id", "turn", "role", "text", F.lit(1).alias("copies"))
    columns = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    got = conversation_repair.repair(df).collect()
    assert len(got) == len({r["conv_id"] for r in got})
    return {r["conv_id"]: tuple(r[c] for c in columns) for r in got}


def talk(seed, n, conv_id, roles=("user", "assistant", "system", "", "tool", "a", "u", None)):
    r = random.Random(seed)
    texts = ("Yes.", "Yes", "No!", "", " \n", None, "Why?\n", "日本。", "é", "x " * 20 + ".")
    return [
        (conv_id, r.choice((None, i, i, i, i // 2, i + 5)), r.choice(roles), r.choice(texts) if r.random() < 0.5 else f"{i} say {r.choice('.!x')}")
        for i in range(n)
    ]


def test_conversations_of_all_kinds(spark):
    rows = [row for k in range(150) for row in talk(k, k % 12, k)]
    rows += talk(900, 9, None) + [(-1, None, None, None)] * 3 + [(-2, 2**62, "user", "Hi."), (-2, -(2**62), "assistant", "Hi.")]
    assert repaired(spark, rows) == brute_conversations(rows)
    assert repaired(spark, rows, damage=False) == brute_conversations(rows, damage=False)


def test_conversations_that_span_many_ranges(spark):
    """One conversation holds most turns and lies in many partitions and blocks; another one's rows are all equal."""
    rows = talk(1, 1500, 7) + [(8, 3, "user", "same.")] * 700 + [row for k in range(20, 40) for row in talk(k, 5, k)]
    rows += [(9, i, "tool", f"{i}.") for i in range(301)]
    want = brute_conversations(rows, damage=False)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert repaired(spark, rows, damage=False) == want
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_no_conversation(spark):
    assert repaired(spark, []) == {}


def test_weights_joined_are_weights_of_the_whole():
    r = random.Random(3)
    for n in (1, 2, conversation_repair.BLOCK, conversation_repair.BLOCK + 1, 700):
        turns = [(i, r.choice(("u", "a", "s", "x")), r.randint(0, 3)) for i in range(n)]
        whole = conversation_repair.Piece((0,))
        for t in turns:
            whole.add(*t)
        parts, at = [], 0
        while at < n:
            size = r.randint(1, 200)
            part = conversation_repair.Piece((0, 1, 2, 3))
            for t in turns[at : at + size]:
                part.add(*t)
            raw = conversation_repair.packed(*part.weights())
            parts.append(conversation_repair.unpacked(raw))
            at += size
        assert conversation_repair.decided(*conversation_repair.joined(parts)) == conversation_repair.decided(*whole.weights())


# Embeddings


def brute_links(rows, threshold):
    """Numbers of links and smallest ids reached, by all pairs."""
    good = {
        i: np.array(v, float) for i, (_, v) in enumerate(rows)
        if v and all(x is not None and math.isfinite(x) for x in v) and any(v)
    }
    links = {i: [] for i in range(len(rows))}
    for i, a in good.items():
        for j, b in good.items():
            if i != j and len(a) == len(b):
                a1, b1 = a / np.abs(a).max(), b / np.abs(b).max()
                if a1 @ b1 / math.sqrt((a1 @ a1) * (b1 @ b1)) >= threshold:
                    links[i].append(j)
    order = lambda x: (x is None, x or 0)
    found = []
    for i, (vec_id, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        found.append((vec_id, len(links[i]), min((rows[j][0] for j in seen), key=order)))
    return sorted(found, key=repr)


def vectors(seed, n, dim, spread=0.1, groups=5):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(groups, dim))
    rows = [centres[i % groups] + spread * r.normal(size=dim) for i in range(n // 2)] + list(r.normal(size=(n - n // 2, dim)))
    return [[float(x) for x in row] for row in rows]


def linked(spark, rows, **options):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    df = df.withColumns({c: F.lit("own") for c in ("digest", "raw", "node", "label", "id", "list", "block", "component")})
    got = embedding_dedup.near_vectors(df, **options).collect()
    return sorted(((r["id"], r["n_links"], r["component"]) for r in got), key=repr)


def test_embeddings_of_all_kinds(spark):
    wide, narrow = vectors(1, 400, 24), vectors(2, 60, 3)
    rows = [(1000 - i, v) for i, v in enumerate(wide)] + [(2000 + i, v) for i, v in enumerate(narrow)]
    rows += [(5, wide[0]), (5, wide[0]), (6, [2 * x for x in wide[0]]), (None, wide[0]), (7, [-x for x in wide[0]])]
    rows += [(10, None), (11, []), (12, [0.0] * 24), (13, [None, *wide[0][1:]]), (14, [math.nan, *wide[0][1:]])]
    rows += [(15, [math.inf, *wide[0][1:]]), (None, None), (16, [1e300, 1e300, 0.0]), (17, [1e-300, 1e-300, 0.0]), (18, [4.0]), (19, [9.0])]
    # Without loss where every list within reach is asked; blocks of eight members cut all groups.
    assert linked(spark, rows, spread=math.inf) == brute_links(rows, 0.95)
    assert linked(spark, rows, spread=math.inf, block=8) == brute_links(rows, 0.95)
    assert linked(spark, rows, spread=math.inf, threshold=0.5, block=16) == brute_links(rows, 0.5)


def test_no_embedding(spark):
    assert linked(spark, []) == []
    assert linked(spark, [(1, None), (2, [0.0])]) == [(1, 0, 1), (2, 0, 2)]


def test_recall_of_links_near_the_threshold(spark):
    """Pairs at a cosine just above the threshold, in any direction, among vectors that lie anywhere."""
    r = np.random.default_rng(5)
    one = embedding_dedup.unit(r.normal(size=(1500, 64)))
    aside = r.normal(size=one.shape)
    aside = embedding_dedup.unit(aside - (aside * one).sum(1, keepdims=True) * one)
    other = 0.951 * one + math.sqrt(1 - 0.951**2) * aside
    rows = [(i, v.tolist()) for i, v in enumerate(np.concatenate([one, other]))]
    got = linked(spark, rows)
    assert all(n <= 1 for _, n, _ in got)
    assert sum(n for _, n, _ in got) >= 0.98 * len(rows)


def test_codes_bound_distances_from_below():
    r = np.random.default_rng(6)
    points = embedding_dedup.unit(r.normal(size=(600, 20)))
    index = embedding_dedup.fit(points, 600, 0.95, 1.5, 64)
    codes, error = index.coded(points - index.centres[0])
    squares = sum(t[:, c] for t, c in zip(index.tables(points[:50] - index.centres[0]), codes.T))
    true = np.linalg.norm(points[:50, None] - points[None], axis=2)
    assert (np.sqrt(np.maximum(squares, 0)) <= true + error + 1e-9).all()


# Spelling variants


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_variants(rows):
    counts = {}
    for doc_id, text in rows:
        run = ""
        for c in (text or "") + " ":
            if "a" <= c <= "z" or "A" <= c <= "Z" or "À" <= c <= "ÿ":
                run += c.lower() if c < "\x80" else c
            elif run:
                h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
                if h % 199 == 0:
                    run = run[: h % len(run)] + run[h % len(run) + 1 :]
                counts[run] = counts.get(run, 0) + 1
                run = ""
    words = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    near = {w: [x for x in words if one_edit(w, x)] for w in words}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 5 * words[w] else None
    found = set()
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        found.add((w, form[w], root, n, len(near[w]), words[form[w]] if form[w] else None))
    return found


def spelled(spark, rows, **options):
    df = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], data.SCHEMA).repartition(4)
    df = df.withColumns({c: F.lit("own") for c in ("word", "n", "form", "root", "size", "back", "column", "count", "start")})
    got = spelling_variants.variants(df, **options).collect()
    found = {(r["word"], r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in got}
    assert len(found) == len(got)
    return found


def spelling_rows():
    r = random.Random(9)
    rows = []
    words = ["".join(r.choice("abé") for _ in range(r.randint(6, 9))) for _ in range(1500)]
    chain = [("rootwordx", 800), ("rootwordy", 150), ("rootwordyy", 29), ("rotwordyy", 5), ("Rootwordx", 40), ("ÀÉword", 6), ("àéword", 31)]
    for i in range(40):
        rows.append((i, " ".join(r.choice(words) for _ in range(700)) + "x" * (i % 3)))
    for i, (w, n) in enumerate(chain):
        rows += [(100 + i * 1000 + k // 5, f"{w}, " * 5) for k in range(0, n, 5)]
    rows += [(None, "nullword 123 nullword_nullword×nullword nullword"), (None, "nullwordé " * 5), (3, None), (4, ""), (5, "·–— 123")]
    rows += [(900, "l" * 70_000 + " m"), (901, ("longword" * 3 + " ") * 20_000), (901, ("longword" * 3 + " ") * 20_000)]
    rows += [(k, ("z" * 400 + " ") * 5 + ("z" * 401 + " ") * 30) for k in (910, 911)]
    return rows


def test_spelling_variants(spark):
    rows = spelling_rows()
    want = brute_variants(rows)
    assert {w for w, f, root, *_ in want if f and root != f}
    assert spelled(spark, rows) == want
    # Groups cut into squares of blocks.
    assert spelled(spark, rows, block=7) == want


def test_no_word(spark):
    assert spelled(spark, []) == set()
    assert spelled(spark, [(1, None), (2, "short words"), (3, "lonesome")]) == set()


def test_sorted_list_scan():
    r = random.Random(1)
    for _ in range(150):
        low = r.choice((0, 1, 3))
        start = "".join(r.choice("ab") for _ in range(low))
        words = sorted({start + "".join(r.choice("abé") for _ in range(r.randint(3, 6))) for _ in range(r.randint(1, 150))})
        scan = spelling_variants.SortedList(words)
        for w in words:
            assert [words[i] for i in scan.one_edit(w, low)] == [x for x in words if x != w and one_edit(w, x)]
