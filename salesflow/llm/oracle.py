"""SQL counterparts of the queries that SQL can express."""

from __future__ import annotations

from salesflow.llm.mixing import MOST, SEEDS, TOTAL, WEIGHTS
from salesflow.llm.queries import URL_RULES
from salesflow.llm.url_filters import DAMPING, LINK, THRESHOLD, TOLERANCE


def _mix() -> str:
    weight = "CASE rank % {n} {cases} END".format(
        n=len(WEIGHTS), cases=" ".join(f"WHEN {i} THEN {float(w)}" for i, w in enumerate(WEIGHTS))
    )
    hashed = "CAST(CAST('0x' || substr(md5({seed} || ':' || coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || content), 1, 8) AS BIGINT) AS DOUBLE) / 4294967296.0"
    return f"""
WITH d AS (
  SELECT doc_id, source, md5(coalesce(text, '')) AS content,
    CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
r AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank FROM s),
w AS (SELECT *, {weight} AS weight FROM r),
l AS (SELECT *,
    row_number() OVER (ORDER BY source_size / weight, rank) AS ord,
    ({TOTAL} * sum(source_size) OVER () - {MOST} * coalesce(sum(source_size) OVER (
      ORDER BY source_size / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / (sum(weight) OVER () - coalesce(sum(weight) OVER (
      ORDER BY source_size / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0)) AS level
  FROM w),
first_level AS (SELECT arg_min(level, ord) AS water FROM l WHERE level * weight <= {MOST} * source_size),
t AS (SELECT source, source_size, CAST(least({MOST} * source_size, water * weight) AS DOUBLE) AS target
  FROM l, first_level),
p AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate FROM t),
j AS (SELECT d.doc_id, d.size, d.content, p.* FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source),
k AS (SELECT CAST(range AS INTEGER) AS seed FROM range({SEEDS})),
c AS (SELECT doc_id, size, source, source_size, target, seed,
    size * CAST(floor(rate) + CASE WHEN {hashed.format(seed='seed')} < rate - floor(rate) THEN 1 ELSE 0 END AS BIGINT) AS taken
  FROM j, k),
m AS (SELECT source, seed, abs(sum(taken) - any_value(target)) AS miss FROM c GROUP BY source, seed),
b AS (SELECT source, arg_min(seed, (miss, seed)) AS seed FROM m GROUP BY source)
SELECT c.doc_id, c.size, c.source_size, c.target, c.taken
FROM c JOIN b ON c.source IS NOT DISTINCT FROM b.source AND c.seed = b.seed
"""


WARC = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
  FROM pages),
f AS (SELECT payload_digest, min(page_id) AS first_id FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT p.page_id, CAST(p.payload_bytes AS BIGINT) AS payload_bytes, p.payload_digest,
  CASE WHEN p.page_id IS DISTINCT FROM f.first_id AND f.first_id IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN p.page_id IS DISTINCT FROM f.first_id THEN f.first_id END AS refers_to
FROM p LEFT JOIN f ON p.payload_digest = f.payload_digest AND p.payload_bytes >= 100
"""


def _urls() -> str:
    """The same rounds until the ranks stand; both directions at once."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    cases = []
    for rule in sorted(URL_RULES, key=len, reverse=True):
        host, slash, start = rule.partition("/")
        cases.append(
            f"WHEN (host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{slash + start}') THEN '{rule}'"
        )
    verdicts = " ".join(f"WHEN '{r}' THEN '{v}'" for r, v in URL_RULES.items())
    link = LINK.replace("'", "''")
    return f"""
WITH RECURSIVE parts AS (
  SELECT page_id, html,
    translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), '{upper}', '{lower}') AS host,
    coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
ruled AS (SELECT *, CASE {" ".join(cases)} END AS rule FROM parts),
judged AS (SELECT *, CASE rule {verdicts} END AS ruling FROM ruled),
counts AS (SELECT host, count(*) AS n, count(*) FILTER (ruling = 'allow') AS allowed,
    count(*) FILTER (ruling = 'block') AS blocked FROM judged WHERE host <> '' GROUP BY host),
seeds AS MATERIALIZED (SELECT host, CASE WHEN 2 * allowed > n THEN 'trust' ELSE 'distrust' END AS kind
  FROM counts WHERE 2 * allowed > n OR 2 * blocked > n),
found AS (SELECT host AS source, translate(unnest(regexp_extract_all(html, '{link}', 1)), '{upper}', '{lower}') AS target FROM judged),
edges AS (SELECT source, target, count(*) AS n FROM found WHERE source <> '' AND source <> target GROUP BY ALL),
both_ways AS (SELECT source AS host, target, n, 'trust' AS kind FROM edges
  UNION ALL SELECT target, source, n, 'distrust' FROM edges),
shares AS MATERIALIZED (SELECT host, target, kind, n / sum(n) OVER (PARTITION BY host, kind) AS share FROM both_ways),
mass AS MATERIALIZED (SELECT kind, count(*) AS m FROM seeds GROUP BY kind),
ranks AS (
  SELECT 0 AS round, host, kind, 1.0::DOUBLE AS seed, 1.0::DOUBLE AS rank, true AS moving FROM seeds
  UNION ALL
  SELECT round, host, kind, seed, rank, sum(abs(rank - old)) OVER () > {TOLERANCE} * (SELECT sum(m) FROM mass)
      OR count(*) FILTER (fresh) OVER () > 0
  FROM (SELECT t.round, t.host, t.kind, seed, old, fresh, {DAMPING} * inward + seed * ({1 - DAMPING} + {DAMPING}
        * (m - sum(inward) OVER (PARTITION BY t.kind)) / m) AS rank
    FROM (SELECT max(round) + 1 AS round, host, kind, sum(seed) AS seed, sum(inward) AS inward, sum(old) AS old,
          count(old) = 0 AS fresh
        FROM (SELECT round, host, kind, seed, 0.0 AS inward, rank AS old FROM ranks WHERE moving
          UNION ALL SELECT round, e.target, e.kind, 0.0, e.share * r.rank, NULL
          FROM shares e JOIN ranks r ON e.host = r.host AND e.kind = r.kind WHERE moving)
        GROUP BY host, kind) t JOIN mass ON mass.kind = t.kind)
  ),
scores AS (SELECT host, coalesce(sum(rank) FILTER (kind = 'trust'), 0) AS trust,
    coalesce(sum(rank) FILTER (kind = 'distrust'), 0) AS distrust FROM ranks
  WHERE round = (SELECT max(round) FROM ranks) GROUP BY host)
SELECT page_id, j.host, path, rule,
  coalesce(ruling, CASE WHEN s.distrust > {THRESHOLD} * (s.trust + s.distrust) THEN 'block' ELSE 'allow' END) AS verdict
FROM judged j LEFT JOIN scores s ON j.host = s.host
"""


# Every pair of texts that shares an n-gram, compared on whole sets.
NEAR_TEXTS = r"""
WITH RECURSIVE words AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[^\x20\x09-\x0D]+') AS w FROM documents),
grams AS MATERIALIZED (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda k: array_to_string(w[k:k + 4], ' ')) END) AS g
  FROM words WHERE doc_id IS NOT NULL),
sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
shared AS MATERIALIZED (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS MATERIALIZED (SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE c >= 0.8 * (x.n + y.n - c) - 1e-9),
reach AS (SELECT doc_id AS id, doc_id AS r FROM documents WHERE doc_id IS NOT NULL
  UNION SELECT id, b FROM reach JOIN links ON r = a),
copies AS (SELECT w, count(*) AS n FROM words WHERE len(w) > 0 AND doc_id IS NOT NULL GROUP BY w)
SELECT d.doc_id, (SELECT min(r) FROM reach WHERE id = d.doc_id) AS class_id,
  (SELECT count(*) FROM links WHERE a = d.doc_id) AS n_links,
  CAST(coalesce(c.n, 1) AS BIGINT) AS n_copies
FROM words d LEFT JOIN copies c ON d.w = c.w WHERE d.doc_id IS NOT NULL
"""

# Every pair of vectors, compared.
NEAR_VECTORS = """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
usable AS MATERIALIZED (SELECT vec_id, e, sqrt(list_dot_product(e, e)) AS n FROM v
  WHERE len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND list_dot_product(e, e) > 0),
links AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b ON a.vec_id <> b.vec_id
  WHERE CASE WHEN len(a.e) = len(b.e) THEN list_dot_product(a.e, b.e) / (a.n * b.n) >= 0.95 ELSE false END),
reach AS (SELECT vec_id AS id, vec_id AS r FROM v UNION SELECT id, b FROM reach JOIN links ON r = a),
named AS (SELECT id, min(r) AS component_id FROM reach GROUP BY id)
SELECT vec_id, (SELECT count(*) FROM links WHERE a = vec_id) AS n_links, component_id,
  vec_id = component_id AS kept
FROM v JOIN named ON id = vec_id
"""


def _crc32(text: str) -> str:
    """CRC-32 of a short ASCII text, bit by bit."""
    bit = "list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))"
    codes = f"list_transform(string_split({text}, ''), lambda s: CAST(ascii(s) AS BIGINT))"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {codes}), lambda c, b: {bit}), 4294967295)"


def _repair() -> str:
    """Conversations from their last row to the first; each state keeps (cost, audit, lines)."""
    after = [2, 2, 3, 2]
    empty = {2: "'user:'", 3: "'assistant:'"}
    said = {2: "'user:' || text", 3: "'assistant:' || text"}

    def option(cost: str, letters: str, lines: str, of: str) -> str:
        return f"struct_pack(c := {cost} + {of}.c, a := '{letters}' || {of}.a, l := list_concat([{lines}]::VARCHAR[], {of}.l))"

    def least(options: list[str]) -> str:
        return f"list_min(list_filter([{', '.join(options)}], lambda o: o IS NOT NULL))"

    legal = [{"u": 2, "s": 1}, {"u": 2}, {"a": 3}, {"u": 2}]
    rows, closed = [], []
    for x in range(4):
        keep = " ".join(f"WHEN initial = '{k}' THEN {option('extra', 'K', 'line', f't{y}')}" for k, y in legal[x].items())
        rerole = option("3 + extra", "R", said[after[x]], f"t{after[x]}")
        options = [option("4", "D", "", f"t{x}"), f"CASE WHEN forced THEN NULL {keep} END", f"CASE WHEN NOT forced THEN {rerole} END"]
        rows.append(f"{least(options)} AS r{x}")
        options, y, lines = [f"r{x}"], x, []
        for j in range(1, 4):
            y = after[y]
            lines.append(empty[y])
            options.append(option(str(3 * j), "I" * j, ", ".join(lines), f"r{y}"))
        closed.append(f"{least(options)} AS t{x}")
    ends = [(0, "", ""), (6, "II", "'user:', 'assistant:'"), (3, "I", "'assistant:'"), (0, "", "")]
    first = ", ".join(f"struct_pack(c := {c}::BIGINT, a := '{a}', l := [{line}]::VARCHAR[]) AS t{x}" for x, (c, a, line) in enumerate(ends))
    tail = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    hit = _crc32("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")
    return f"""
WITH RECURSIVE hit AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {hit} % 20 AS hit FROM conversations),
kept AS (SELECT conv_id, turn, CASE hit WHEN 4 THEN 'user' ELSE role END AS role,
    CASE hit WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE hit WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM hit WHERE hit <> 0),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS seen,
    rtrim(text, {tail}) AS body FROM kept),
faults AS MATERIALIZED (SELECT *, role[1:1] AS initial, role || ':' || text AS line,
    CASE WHEN body = '' THEN 'blank' WHEN seen > 1 THEN 'duplicate'
      WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
    lag(role[1:1]) OVER (PARTITION BY conv_id ORDER BY i) AS before
  FROM placed),
counts AS (SELECT conv_id, CAST(coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS BIGINT) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
  FROM faults GROUP BY conv_id),
steps AS (
  SELECT conv_id, n + 1 AS i, {first} FROM counts
  UNION ALL
  SELECT conv_id, i, {", ".join(closed)} FROM (
    SELECT conv_id, i, {", ".join(rows)} FROM (
      SELECT f.conv_id, f.i, t0, t1, t2, t3, initial, line, text, fault IN ('blank', 'duplicate') AS forced,
        CASE fault WHEN 'truncated' THEN 3 ELSE 0 END AS extra
      FROM steps s JOIN faults f ON f.conv_id IS NOT DISTINCT FROM s.conv_id AND f.i = s.i - 1))),
best AS (SELECT conv_id, t0 FROM steps WHERE i = 1)
SELECT d.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(t0.c, 0) AS BIGINT) AS cost,
  coalesce(t0.a, '') AS audit, sha256(coalesce(array_to_string(t0.l, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) d
  LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM d.conv_id
  LEFT JOIN best b ON b.conv_id IS NOT DISTINCT FROM d.conv_id
"""


# Every window of 35 words, spelled out and counted.
REPEATS = r"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (SELECT r, s, array_to_string(w[s:s + 34], ' ') AS g FROM d, unnest(range(1, len(w) - 33)) AS t(s)),
again AS (SELECT r, s FROM windows QUALIFY count(*) OVER (PARTITION BY g) > 1),
gone AS (SELECT DISTINCT r, unnest(range(s, s + 35)) AS p FROM again),
one AS (SELECT r, unnest(range(1, len(w) + 1)) AS p, unnest(w) AS word FROM d),
kept AS (SELECT o.r, string_agg(o.word, ' ' ORDER BY o.p) AS text, count(*) AS n
  FROM one o ANTI JOIN gone g ON g.r = o.r AND g.p = o.p GROUP BY o.r)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(k.text, '')) AS kept_sha256
FROM d LEFT JOIN kept k ON k.r = d.r
"""

PHRASES = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
    unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
w AS MATERIALIZED (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
grams AS (
  SELECT lang, k AS words, array_to_string(w[s:s + k - 1], ' ') AS phrase
  FROM w, range(1, 5) AS t(k), unnest(range(1, len(w) - k + 2)) AS u(s)),
f AS MATERIALIZED (SELECT lang, words, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 30),
sizes AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang),
c AS MATERIALIZED (SELECT lang, words, phrase, f AS a, string_split(phrase, ' ') AS p FROM f WHERE words > 1),
cuts AS (SELECT lang, words, phrase, a, k, array_to_string(p[1:k], ' ') AS p1, array_to_string(p[k + 1:], ' ') AS p2
  FROM c, unnest(range(1, words)) AS t(k)),
scores AS (SELECT c.lang, c.phrase, c.a, k, x.f AS l, y.f AS r,
    CAST((2000000::HUGEINT * c.a) // (x.f::HUGEINT + y.f) AS BIGINT) AS score
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = p1 JOIN f y ON y.lang = c.lang AND y.phrase = p2),
lowest AS (SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_parts AS (SELECT lang, array_to_string(p[s:s + k - 1], ' ') AS phrase, max(a) AS longer
  FROM c, unnest(range(2, words)) AS t(k), unnest(range(1, words - k + 2)) AS u(s) GROUP BY ALL),
kept AS (SELECT l.* FROM lowest l LEFT JOIN inner_parts i ON i.lang = l.lang AND i.phrase = l.phrase
  WHERE coalesce(100 * i.longer::HUGEINT < 80 * l.a::HUGEINT, true)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT r.lang, rank, phrase, a, l, r.r AS r, n, score FROM ranked r JOIN sizes s ON s.lang = r.lang WHERE rank <= 2000
"""


ORACLE = {
    "op2_mix_sources": _mix(),
    "op5_ngram_join": NEAR_TEXTS,
    "op6_warc": WARC,
    "op8_url_filters": _urls(),
    "op10_lattice_dedup": NEAR_VECTORS,
    "op11_conversation_repair": _repair(),
    "op12_substring_dedup": REPEATS,
    "op13_collocations": PHRASES,
}
