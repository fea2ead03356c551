"""SQL that gives the same rows as the queries, where SQL can; written for DuckDB."""

from __future__ import annotations

from sportmart.llm import embedding_dedup, license_scan, line_dedup, quality_rules, sharding, spelling_variants, substring_dedup

#: The table of CRC-32 as a list ``t``, and the CRC-32 of a list of bytes under it.
CRC_TABLE = """crc_table AS (
  SELECT list(list_reduce(list_prepend(k, range(8)), lambda c, i:
      CASE WHEN c & 1 = 1 THEN xor(3988292384::BIGINT, c >> 1) ELSE c >> 1 END) ORDER BY k) AS t
  FROM (SELECT unnest(range(256)) AS k))"""
BYTES = "list_transform(regexp_extract_all(hex(encode({})), '..'), lambda x: ('0x' || x)::BIGINT)"
CRC = "xor(list_reduce(list_prepend(4294967295::BIGINT, {}), lambda c, x: xor(t[(xor(c, x) & 255) + 1], c >> 8)), 4294967295)"
WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def quality() -> str:
    rules = quality_rules.RULES
    cutoffs = ", ".join(f"({c}::DOUBLE)" for c in quality_rules.CUTOFFS)
    p = quality_rules.RISK / len(rules)
    share = "least(1.0::DOUBLE, ({})::DOUBLE / greatest({}, 1))"
    return f"""
WITH split AS (
  SELECT doc_id, coalesce(lang, '') AS stratum, coalesce(text, '') AS text, {WORDS} AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
  FROM documents),
grams AS (
  SELECT doc_id, i, array_to_string(list_slice(words, i, i + 4), ' ') AS gram
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 3)) AS i FROM split)),
twice AS (SELECT doc_id, gram FROM grams GROUP BY ALL HAVING count(*) > 1),
covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n
  FROM grams JOIN twice USING (doc_id, gram), (SELECT unnest(range(5)) AS k) GROUP BY doc_id),
counts AS (
  SELECT doc_id, stratum, len(words)::BIGINT AS n_words,
         length(regexp_replace(text, '[\\x20\\x09-\\x0D]+', '', 'g'))::BIGINT AS word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
         len(regexp_extract_all(text, '[A-Z]'))::BIGINT AS n_capitals,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, len(lines) AS n_lines,
         coalesce(n, 0)::BIGINT AS n_repeat_words
  FROM split LEFT JOIN covered USING (doc_id)),
measured AS (
  SELECT *, n_words < {quality_rules.MIN_WORDS} OR 100 * n_repeat_words > 20 * n_words AS base_failed,
         {share.format('n_symbols', 'word_chars')} AS symbols, {share.format('n_repeat_words', 'n_words')} AS repeats,
         {share.format('n_dup_lines', 'n_lines')} AS dup_lines, {share.format('n_capitals', 'word_chars')} AS capitals
  FROM counts),
good AS (
  SELECT doc_id FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id HAVING min(quality) = 1),
held AS (
  SELECT stratum, rule, value
  FROM (SELECT stratum, {', '.join(rules)} FROM measured SEMI JOIN good USING (doc_id) WHERE NOT base_failed)
  UNPIVOT (value FOR rule IN ({', '.join(rules)}))),
trials AS (
  SELECT stratum, rule, cutoff, count(*) AS n, count(*) FILTER (WHERE value >= cutoff) AS k
  FROM held, (VALUES {cutoffs}) AS c(cutoff) GROUP BY ALL),
tests AS (
  SELECT *, CASE WHEN k >= n * {p}::DOUBLE THEN 1 ELSE list_sum(list_transform(range(0, k + 1), lambda j:
      exp(lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1) + j * ln({p}::DOUBLE) + (n - j) * ln(1 - {p}::DOUBLE)))) END
      <= {quality_rules.ERROR}::DOUBLE / ((SELECT count(DISTINCT stratum) FROM held) * {len(rules)}) AS accepted
  FROM trials),
chosen AS (
  SELECT stratum, rule, min(cutoff) AS cut
  FROM (SELECT *, max(CASE WHEN NOT accepted THEN cutoff END) OVER (PARTITION BY stratum, rule) AS failed FROM tests)
  WHERE accepted AND cutoff > coalesce(failed, -1) GROUP BY ALL),
cuts AS (
  SELECT stratum, {', '.join(f"max(cut) FILTER (WHERE rule = '{r}') AS cut_{r}" for r in rules)} FROM chosen GROUP BY stratum)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed {' '.join(f'AND NOT coalesce({r} >= cut_{r}, false)' for r in rules)} AS kept,
       stratum, {', '.join(f'cut_{r}' for r in rules)}
FROM measured LEFT JOIN cuts USING (stratum)"""


def lines() -> str:
    return f"""
WITH split AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS place
  FROM documents),
worded AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY place) AS i, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n
  FROM split WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
chunks AS (
  SELECT doc_id, i, line || chr(10) || lead(line) OVER (PARTITION BY doc_id ORDER BY i) AS chunk FROM worded),
judged AS (
  SELECT doc_id, i, min(doc_id) OVER (PARTITION BY chunk) < doc_id OR min(i) OVER (PARTITION BY doc_id, chunk) + 2 <= i AS seen
  FROM chunks WHERE chunk IS NOT NULL),
marked AS (
  SELECT doc_id, i, i - coalesce(lag(i) OVER (PARTITION BY doc_id ORDER BY i), -9) > 2 AS fresh FROM judged WHERE seen),
grown AS (
  SELECT doc_id, i, sum(fresh::INT) OVER (PARTITION BY doc_id ORDER BY i) AS passage FROM marked),
spans AS (SELECT doc_id, passage, min(i) AS a, max(i) + 1 AS b FROM grown GROUP BY doc_id, passage),
counted AS (
  SELECT doc_id, passage, sum(n) AS n, min(place) AS first_place, max(place) AS last_place
  FROM spans JOIN worded USING (doc_id) WHERE i BETWEEN a AND b GROUP BY doc_id, passage),
gone AS (
  SELECT doc_id, unnest(range(first_place, last_place + 1)) AS place FROM counted WHERE n >= {line_dedup.MIN_WORDS}),
done AS (
  SELECT doc_id, string_agg(line, chr(10) ORDER BY place) AS left_over FROM split ANTI JOIN gone USING (doc_id, place) GROUP BY doc_id)
SELECT doc_id, CASE WHEN text IS NULL THEN 0 ELSE len(string_split(text, chr(10))) END::BIGINT AS n_lines,
       CASE WHEN text IS NULL OR coalesce(left_over, '') = text THEN 0 ELSE len(string_split(text, chr(10)))
            - CASE WHEN coalesce(left_over, '') = '' THEN 0 ELSE len(string_split(left_over, chr(10))) END END::BIGINT AS n_removed,
       CASE WHEN text IS NOT NULL THEN coalesce(left_over, '') END AS text
FROM documents LEFT JOIN done USING (doc_id)"""


def licenses() -> str:
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    templates = ", ".join(
        f"({i}, {quoted(label)}, {quoted(w)})"
        for i, (label, words) in enumerate(license_scan.template_words(license_scan.TEMPLATES)) for w in sorted(words)
    )
    widths = ", ".join(
        f"({i}, {width})"
        for i, (_, _, width) in enumerate(license_scan.window_templates(license_scan.TEMPLATES, license_scan.THRESHOLD))
    )
    phrases = ", ".join(
        f"({quoted(label)}, [{', '.join(map(quoted, p.split()))}])" for p, label in license_scan.PHRASES
    )
    word = "regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    return f"""
WITH split AS (SELECT doc_id, coalesce(text, '') AS text, {word.format("coalesce(text, '')")} AS words FROM documents),
places AS (
  SELECT doc_id, label, i - 1 AS place
  FROM (SELECT doc_id, words, unnest(range(1, len(words) + 1)) AS i FROM split),
       (VALUES {phrases}) AS p(label, phrase)
  WHERE words[i] = phrase[1] AND list_slice(words, i, i + len(phrase) - 1) = phrase),
base AS (
  SELECT doc_id, count(*) AS n, min(place) AS a, max(place) AS b, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
  FROM places GROUP BY doc_id),
lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS i
  FROM split),
template AS (SELECT * FROM (VALUES {templates}) AS t(template, label, word)),
sizes AS (SELECT template, count(*) AS n FROM template GROUP BY template),
hits AS (
  SELECT DISTINCT doc_id, i - back AS s, template, label, t.word
  FROM (SELECT doc_id, i, unnest({word.format('line')}) AS word FROM lines) AS l JOIN template AS t ON l.word = t.word,
       (SELECT unnest(range({license_scan.BLOCK_LINES})) AS back)
  WHERE i - back >= 1),
blocks AS (
  SELECT doc_id, label, count(*)::DOUBLE / any_value(n) AS containment
  FROM hits JOIN sizes USING (template) GROUP BY doc_id, s, template, label
  HAVING count(*) >= {license_scan.THRESHOLD} * any_value(n) - 1e-9),
spots AS (
  SELECT doc_id, i, template, label, t.word
  FROM (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM split) AS w JOIN template AS t ON w.word = t.word),
held AS (
  SELECT doc_id, template, any_value(n) AS n, any_value(width) AS width
  FROM spots JOIN sizes USING (template) JOIN (VALUES {widths}) AS v(template, width) USING (template)
  GROUP BY doc_id, template HAVING count(DISTINCT word) >= {license_scan.THRESHOLD} * any_value(n) - 1e-9),
windows AS (
  SELECT doc_id, label, n, count(DISTINCT word) OVER (
      PARTITION BY doc_id, template ORDER BY i RANGE BETWEEN CURRENT ROW AND width - 1 FOLLOWING) AS k
  FROM spots JOIN held USING (doc_id, template)),
matched AS (
  SELECT doc_id, label, containment FROM blocks
  UNION ALL SELECT doc_id, label, k::DOUBLE / n FROM windows WHERE k >= {license_scan.THRESHOLD} * n - 1e-9),
found AS (SELECT doc_id, max(containment) AS containment FROM matched GROUP BY doc_id),
every AS (
  SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
  FROM (SELECT doc_id, label FROM matched UNION SELECT doc_id, label FROM places) GROUP BY doc_id)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(base.n, 0)::BIGINT AS n_base, a::BIGINT AS first_word,
       b::BIGINT AS last_word, coalesce(base.labels, '') AS base_labels, coalesce(every.labels, '') AS labels,
       CASE WHEN base.n > 0 THEN 1.0::DOUBLE ELSE coalesce(containment, 0.0::DOUBLE) END AS score
FROM split LEFT JOIN base USING (doc_id) LEFT JOIN found USING (doc_id) LEFT JOIN every USING (doc_id)"""


def shards() -> str:
    step = sharding.feistel_sql
    return f"""
WITH RECURSIVE crc_table AS (
  SELECT list(list_reduce(list_prepend(k, range(8)), lambda c, i:
      CASE WHEN c & 1 = 1 THEN xor(3988292384::BIGINT, c >> 1) ELSE c >> 1 END) ORDER BY k) AS t
  FROM (SELECT unnest(range(256)) AS k)),
bytes AS (
  SELECT doc_id, text, CASE WHEN text IS NULL THEN 0 ELSE octet_length(encode(text)) END::BIGINT + 8 AS size,
         list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda x: ('0x' || x)::BIGINT) AS b
  FROM documents),
slim AS (
  SELECT doc_id, size, CASE WHEN text IS NOT NULL THEN
      xor(list_reduce(list_prepend(4294967295::BIGINT, b), lambda c, x: xor(t[(xor(c, x) & 255) + 1], c >> 8)), 4294967295)
      END AS text_crc32
  FROM bytes, crc_table),
numbered AS (
  SELECT *, row_number() OVER (ORDER BY md5(concat_ws('|', coalesce(doc_id::VARCHAR, '~'), coalesce(size::VARCHAR, '~'),
      coalesce(text_crc32::VARCHAR, '~'))), doc_id, size, text_crc32) - 1 AS row_number
  FROM slim),
total AS (SELECT count(*) AS n FROM slim),
sides AS (
  SELECT n, a, (n + a - 1) // a AS b
  FROM (SELECT n, unnest(range(0, 4096)) + floor(sqrt(n - 1))::BIGINT + 1 AS a FROM total)
  ORDER BY (a - n % a) % a, a LIMIT 1),
walk AS (
  {step('(SELECT row_number, row_number AS x, n, a, b FROM numbered, sides)', 'x', 'a', 'b')}
  UNION ALL
  {step('(SELECT row_number, y AS x, n, a, b FROM walk WHERE y >= n)', 'x', 'a', 'b')})
SELECT doc_id, size, text_crc32, 'rows' AS law, (y % {sharding.SHARDS})::INT AS shard, y // {sharding.SHARDS} AS slot,
       NULL::INT AS grown_shard, row_number
FROM numbered JOIN (SELECT row_number, y FROM walk WHERE y < n) USING (row_number)"""


def substrings() -> str:
    n = substring_dedup.WINDOW
    return f"""
WITH split AS (SELECT doc_id, {WORDS} AS words FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(list_slice(words, i, i + {n - 1}), ' ') AS w
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - {n - 2})) AS i FROM split)),
later AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY w) AS first FROM windows) WHERE first < doc_id),
gone AS (
  SELECT doc_id, list(DISTINCT i + k) AS places FROM later, (SELECT unnest(range({n})) AS k) GROUP BY doc_id),
positions AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM split),
dropped AS (SELECT doc_id, unnest(places) AS i FROM gone),
kept AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS text
  FROM positions ANTI JOIN dropped USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, len(words)::BIGINT AS n_words, (len(words) - coalesce(kept.n, 0))::BIGINT AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM split LEFT JOIN kept USING (doc_id)"""


def repairs() -> str:
    """Best ends of a conversation, from its last turn to its first; audits are compared as text."""
    key = "concat(coalesce(conv_id::VARCHAR, ' '), ':', coalesce(turn::VARCHAR, ' '))"
    after = {0: 2, 1: 2, 2: 3, 3: 2}
    role = {2: "user", 3: "assistant"}

    def best(*paths: str) -> str:
        return f"list_min(list_filter([{', '.join(paths)}], lambda p: p IS NOT NULL))"

    def path(cost: str, letter: str, end: str, line: str = "") -> str:
        lines = f"list_prepend({line}, {end}.lines)" if line else f"{end}.lines"
        return f"{{'cost': {cost} + {end}.cost, 'audit': '{letter}' || {end}.audit, 'lines': {lines}}}"

    def own(state: int) -> str:
        """Paths whose first letter is the turn's own."""
        to = after[state]
        kept = {"u": "q2", "a": "q3", "s": "q1"}
        legal = {0: "su", 1: "u", 2: "a", 3: "u"}[state]
        keeps = [
            f"CASE WHEN fault IN (0, 3) AND initial = '{x}' THEN {path('cut', 'K', kept[x], 'line')} END" for x in legal
        ]
        changed = f"'{role[to]}:' || text"
        change = f"CASE WHEN fault IN (0, 3) THEN {path('2 + cut', 'R', f'q{to}', changed)} END"
        return best(path("3", "D", f"q{state}"), change, *keeps)

    owns = ",\n         ".join(f"{own(q)} AS o{q}" for q in range(4))
    news = ", ".join(
        f"""list_min([o{q}, {path("2", "I", f"o{after[q]}", f"'{role[after[q]]}:'")}]) AS q{q}""" for q in range(4)
    )
    nothing = "{'cost': 0::BIGINT, 'audit': '', 'lines': []::VARCHAR[]}"
    one = "{'cost': 2::BIGINT, 'audit': 'I', 'lines': ['assistant:']}"
    two = "{'cost': 4::BIGINT, 'audit': 'II', 'lines': ['user:', 'assistant:']}"
    return f"""
WITH RECURSIVE {CRC_TABLE},
lots AS (
  SELECT *, {CRC.format(BYTES.format(key))} % 20 AS lot FROM conversations, crc_table),
damaged AS (
  SELECT conv_id, turn, CASE WHEN lot = 4 THEN 'user' ELSE coalesce(role, ' ') END AS role,
         CASE lot WHEN 1 THEN '' WHEN 2 THEN regexp_replace(coalesce(text, ' '), '[.!?]', '', 'g') ELSE coalesce(text, ' ') END AS text,
         unnest(range(CASE lot WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM lots),
ordered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS i,
         left(role, 1) AS initial, regexp_replace(text, '[\\x20\\x09-\\x0D]+', '', 'g') AS bare
  FROM damaged),
judged AS (
  SELECT *, CASE WHEN bare = '' THEN 1
      WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 2
      WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault,
      lag(initial) OVER (PARTITION BY conv_id ORDER BY i) AS before, role || ':' || text AS line
  FROM ordered),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
         count(*) FILTER (WHERE fault = 1) AS blank, count(*) FILTER (WHERE fault = 2) AS duplicate,
         count(*) FILTER (WHERE fault = 3) AS truncated,
         count(*) FILTER (WHERE before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n
  FROM judged GROUP BY conv_id),
owned AS (SELECT *, (fault = 3)::BIGINT AS cut FROM judged),
walk AS (
  SELECT conv_id, n AS i, {nothing} AS q0, {two} AS q1, {one} AS q2, {nothing} AS q3 FROM counts
  UNION ALL
  SELECT conv_id, i - 1 AS i, {news}
  FROM (
    SELECT w.conv_id, w.i,
         {owns}
    FROM walk AS w JOIN owned AS r ON w.conv_id IS NOT DISTINCT FROM r.conv_id AND w.i = r.i)),
best AS (SELECT conv_id, q0 FROM walk WHERE i = 0)
SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(q0.cost, 0)::BIGINT AS cost,
       coalesce(q0.audit, '') AS audit, sha256(coalesce(array_to_string(q0.lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) AS c
LEFT JOIN counts ON c.conv_id IS NOT DISTINCT FROM counts.conv_id
LEFT JOIN best ON c.conv_id IS NOT DISTINCT FROM best.conv_id"""


def spellings() -> str:
    """Two words are one replacement apart if both less their i-th letter are equal, one insertion if one less a letter is the other."""
    v = spelling_variants
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
WITH RECURSIVE {CRC_TABLE},
runs AS (
  SELECT doc_id, run, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all({lower}, '[A-Za-zÀ-ÿ]+')) AS run FROM documents) GROUP BY ALL),
hashed AS (
  SELECT run, n, {CRC.format(BYTES.format("concat(doc_id::VARCHAR, ':', run)"))} AS h
  FROM runs, crc_table WHERE length(run) >= {v.MIN_LENGTH}),
damaged AS (
  SELECT n, CASE WHEN h % {v.ONE_IN} = 0 THEN left(run, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2) ELSE run END AS word
  FROM hashed),
words AS (
  SELECT word, sum(n)::BIGINT AS n FROM damaged WHERE length(word) >= {v.MIN_LENGTH}
  GROUP BY word HAVING sum(n) >= {v.MIN_COUNT}),
less AS (
  SELECT word, n, i, left(word, i - 1) || substr(word, i + 1) AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
near AS (
  SELECT DISTINCT a.word, b.word AS other, b.n AS other_n FROM less AS a JOIN less AS b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM less AS a JOIN words AS b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM less AS a JOIN words AS b ON a.rest = b.word),
best AS (
  SELECT word, count(*) AS n_near, max(other_n) AS most FROM near GROUP BY word),
formed AS (
  SELECT words.word, words.n, coalesce(n_near, 0)::BIGINT AS n_near,
         (SELECT min(other) FROM near WHERE near.word = words.word AND other_n = most AND most >= {v.RATIO} * words.n) AS form,
         CASE WHEN most >= {v.RATIO} * words.n THEN most END::BIGINT AS form_n
  FROM words LEFT JOIN best USING (word)),
ways AS (
  SELECT word, word AS at, form AS next FROM formed
  UNION ALL
  SELECT ways.word, formed.word, formed.form FROM ways JOIN formed ON ways.next = formed.word)
SELECT formed.word, n, n_near, form, form_n, ways.at AS root
FROM formed JOIN ways ON ways.word = formed.word AND ways.next IS NULL"""


def cosines() -> str:
    """All pairs, where the query asks its index; so the rows are the same where the index loses no link, as on the small tables."""
    return f"""
WITH RECURSIVE vectors AS (
  SELECT row_number() OVER (ORDER BY vec_id) AS k, vec_id, embedding::DOUBLE[] AS v,
         len(embedding) > 0 AND list_bool_and(list_transform(embedding, lambda x: coalesce(isfinite(x), false)))
         AND list_bool_or(list_transform(embedding, lambda x: x <> 0)) AS usable
  FROM embeddings),
scaled AS (
  SELECT k, list_transform(v, lambda x: x / sqrt(list_sum(list_transform(v, lambda y: y * y)))) AS u FROM vectors WHERE usable),
links AS (
  SELECT a.k AS a, b.k AS b FROM scaled AS a JOIN scaled AS b ON a.k <> b.k AND len(a.u) = len(b.u)
      AND list_inner_product(a.u, b.u) >= {embedding_dedup.THRESHOLD}),
reach AS (SELECT k AS a, k AS b FROM vectors UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
least AS (SELECT reach.a AS k, min(vec_id) AS component_id FROM reach JOIN vectors ON vectors.k = reach.b GROUP BY reach.a),
numbers AS (SELECT a AS k, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id IS NOT DISTINCT FROM component_id AS kept
FROM vectors JOIN least USING (k) LEFT JOIN numbers USING (k)"""


ORACLE = {
    "op1_quality_rules": quality(),
    "op3_line_dedup": lines(),
    "op8_license_scan": licenses(),
    "op9_sharding": shards(),
    "op10_substring_dedup": substrings(),
    "op11_conversation_repair": repairs(),
    "op12_embedding_dedup": cosines(),
    "op13_spelling_variants": spellings(),
}
