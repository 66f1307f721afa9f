"""DuckDB SQL for the queries of this subpackage that SQL can express.

Each is written from its query's definition, not from the Spark code; what both
must share (the rules, weights, the permutation's and hashes' constants) is
filled in as numbers. No SQL for language models (op3, op7), tokenizers (op5, op10) and
digests (op9): tests hold those against brute force.
"""

from __future__ import annotations

from ordstar.llm import mixing, quality, sharding
from ordstar.llm.queries import MIX_WEIGHTS, SHARDS, URL_RULES

_WORD = r"[^\x20\x09-\x0D]+"
_UP, _LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _md5_long(x: str) -> str:
    return f"('0x' || substr(md5({x}), 1, 15))::BIGINT"


def url_filter_sql() -> str:
    rules = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)
    return f"""
WITH rules(rhost, rpath, rverdict) AS (VALUES {rules}),
parsed AS (
  SELECT page_id, row_number() OVER () AS r,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), '{_UP}', '{_LOW}') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
best AS (
  SELECT r, arg_max(rhost || rpath, length(rhost || rpath)) AS rule, arg_max(rverdict, length(rhost || rpath)) AS verdict
  FROM parsed JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
  GROUP BY r)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM parsed LEFT JOIN best USING (r)
"""


def permuted_sql(name: str, relation: str, keep: str, x: str, n: str, seed: str, out: str) -> str:
    """Two CTEs: the rounds of the swap-or-not shuffle of column ``x``, and ``name`` with its place ``out``."""
    p, q = mixing.PRIME, mixing.SECOND_PRIME
    key = f"((s % 1000003 * 1009 + n % 1000003) * fa + fb) % {p}"
    bit = f"(greatest(v, o) % {p} + k) * {mixing.MIX_A} % {p} * {mixing.MIX_B} % {q} // 512 % 2"
    return f"""
{name}_rounds({keep}, n, s, turns, v) AS (
  SELECT {keep}, {n}, ({seed})::BIGINT, 0, {x} FROM {relation}
  UNION ALL
  SELECT {keep}, n, s, turns + 1, CASE WHEN {bit} = 1 THEN o ELSE v END
  FROM (SELECT *, (k % n - v + n) % n AS o FROM (SELECT *, {key} AS k FROM {name}_rounds JOIN factors ON fr = turns))),
{name} AS (SELECT {keep}, v AS {out} FROM {name}_rounds WHERE turns = {mixing.ROUNDS})"""


def mix_sql() -> str:
    block, buckets = mixing.BLOCK_WORDS, mixing.BUCKETS
    weights = "[" + ", ".join(map(str, MIX_WEIGHTS)) + "]"
    factors = ", ".join(f"({r}, {a}::BIGINT, {b}::BIGINT)" for r, (a, b) in enumerate(mixing.FACTORS))
    return f"""
WITH RECURSIVE factors(fr, fa, fb) AS (VALUES {factors}),
d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{_WORD}'))::BIGINT AS size FROM documents),
s0 AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
s1 AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank FROM s0),
s2 AS (SELECT *, ({weights}[rank % {len(MIX_WEIGHTS)} + 1])::BIGINT AS weight, source_size * 2 AS cap FROM s1),
s3 AS (SELECT *, row_number() OVER o AS nth, coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS fulls,
         sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest, sum(source_size) OVER () AS total
       FROM s2 WINDOW o AS (ORDER BY cap / weight, rank)),
s4 AS (SELECT *, total * 3 - fulls * 2 AS up, rest * 2 AS down FROM s3),
lv AS (SELECT nth AS lnth, up AS lup, down AS ldown FROM s4 WHERE up * weight <= cap * down ORDER BY nth LIMIT 1),
src AS (SELECT source, source_size, rank, weight,
          CASE WHEN nth >= lnth THEN (weight * lup)::DOUBLE / ldown::DOUBLE ELSE cap::DOUBLE END AS target
        FROM s4 LEFT JOIN lv ON true),
q0 AS (SELECT rank, ceil(source_size / {block}.0)::BIGINT AS blocks, target, source_size FROM src WHERE source_size > 0),
q1 AS (SELECT rank, blocks, least(round(blocks * target / source_size)::BIGINT, blocks * 2) AS take FROM q0),
q2 AS (SELECT *, coalesce(sum(take) OVER (ORDER BY rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS first_place FROM q1),
sl AS (SELECT range AS slot, (SELECT sum(take) FROM q2)::BIGINT AS n_all FROM range((SELECT coalesce(sum(take), 0) FROM q2)::BIGINT)),
dk AS (SELECT r, n_all, {_md5_long("n_all || ':' || r")} AS k FROM range({mixing.ROUNDS}) t(r), (SELECT coalesce(sum(take), 0)::BIGINT AS n_all FROM q2) n),
rd AS (SELECT r, (k % greatest(n_all, 1) + n_all)::BIGINT AS m, (k // 2147483648 % {mixing.SECOND_PRIME})::BIGINT AS h, greatest(n_all, 1)::BIGINT AS n FROM dk),
pr AS (SELECT slot, slot::BIGINT AS v, 0 AS r FROM sl
       UNION ALL
       SELECT slot, CASE WHEN t * t % {mixing.PRIME} * {mixing.MIX_B} % {mixing.SECOND_PRIME} // 512 % 2 = 1 THEN mirror ELSE v END, r + 1
       FROM (SELECT slot, v, pr.r AS r, (m - v) % n AS mirror, greatest(v, (m - v) % n) % {mixing.SECOND_PRIME} + h AS t FROM pr JOIN rd ON pr.r = rd.r) x),
pl AS (SELECT slot, v AS place FROM pr WHERE r = {mixing.ROUNDS}),
dl AS (SELECT slot, rank, blocks, (place - first_place) % blocks AS turn, rank * 4099 + (place - first_place) // blocks * 31 + 7 AS seed
       FROM pl JOIN q2 ON place >= first_place AND place < first_place + take),
{permuted_sql("bl", "dl", "slot, rank", "turn", "blocks", "seed", "block")},
rk AS (SELECT rank, doc_id, size, coalesce({_md5_long('doc_id::VARCHAR')}, 0) % {buckets} AS bucket FROM d JOIN src ON d.source IS NOT DISTINCT FROM src.source WHERE size > 0),
pk AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY rank ORDER BY bucket, doc_id NULLS FIRST, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start,
         row_number() OVER () AS r FROM rk),
held AS (SELECT *, unnest(range(start // {block}, (start + size - 1) // {block} + 1)) AS block FROM pk),
taken AS (SELECT r, sum(least(start + size, (block + 1) * {block}) - greatest(start, block * {block}))::BIGINT AS taken,
            min(slot // {mixing.SHARD_BLOCKS})::BIGINT AS first_shard, count(DISTINCT slot // {mixing.SHARD_BLOCKS})::BIGINT AS n_shards
          FROM held JOIN bl USING (rank, block) GROUP BY r),
every AS (SELECT rank, doc_id, size, coalesce(taken, 0) AS taken, first_shard, coalesce(n_shards, 0) AS n_shards FROM pk LEFT JOIN taken USING (r)
          UNION ALL SELECT rank, doc_id, size, 0, NULL, 0 FROM d JOIN src ON d.source IS NOT DISTINCT FROM src.source WHERE size = 0)
SELECT doc_id, size, source_size, target, taken, first_shard, n_shards FROM every JOIN src USING (rank)
"""


def _crc_steps(levels: int) -> tuple[list[int], list[list[int]]]:
    """CRC-32 by its rule (reflected polynomial): the byte table, and for each level
    k where each of 32 state bits goes when 2^k zero bytes follow."""
    table = []
    for byte in range(256):
        for _ in range(8):
            byte = byte >> 1 ^ (0xEDB88320 if byte & 1 else 0)
        table.append(byte)

    def move(matrix: list[int], x: int) -> int:
        out = 0
        for j in range(32):
            out ^= matrix[j] if x >> j & 1 else 0
        return out

    steps = [[(1 << j) >> 8 ^ table[1 << j & 255] for j in range(32)]]
    for _ in range(levels - 1):
        steps.append([move(steps[-1], x) for x in steps[-1]])
    return table, steps


def shards_sql(levels: int = 24) -> str:
    """CRC-32 is linear: neighbouring blocks of 2^k bytes, counted from the text's
    end, are combined level by level (texts up to 2^levels bytes)."""
    table, steps = _crc_steps(levels)

    def moved(matrix: list[int], x: str) -> str:
        out = "0::BIGINT"
        for j, m in enumerate(matrix):
            out = f"xor({out}, (({x} >> {j}) & 1) * {m})"
        return out

    chain = ""
    for k, matrix in enumerate(steps):
        chain += f"""
block{k + 1} AS MATERIALIZED (SELECT r, e // 2 AS e, bit_xor(CASE WHEN e % 2 = 1 THEN {moved(matrix, "x")} ELSE x END) AS x FROM block{k} GROUP BY ALL),
zero{k + 1} AS MATERIALIZED (SELECT r, n, CASE WHEN (n >> {k}) & 1 = 1 THEN {moved(matrix, "z")} ELSE z END AS z FROM zero{k}),"""

    def jump(shards: int) -> str:
        return f"(SELECT r, spot FROM walk WHERE next >= {shards} QUALIFY row_number() OVER (PARTITION BY r ORDER BY next) = 1)"

    return f"""
WITH RECURSIVE sized AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, octet_length(encode(coalesce(text, ''))) AS n, hex(encode(coalesce(text, ''))) AS h,
    CASE WHEN doc_id IS NULL THEN 0 ELSE {_md5_long('doc_id::VARCHAR')} END AS key FROM documents),
bytes AS (SELECT r, n, unnest(regexp_extract_all(h, '..')) AS h, unnest(range(1, n + 1)) AS i FROM sized),
hexes AS (SELECT unnest(range(256)) AS b, unnest({table}::BIGINT[]) AS x),
block0 AS MATERIALIZED (SELECT r, n - i AS e, x FROM bytes JOIN (SELECT printf('%02X', b) AS hb, x FROM hexes) ON h = hb),
zero0 AS MATERIALIZED (SELECT r, n, 4294967295::BIGINT AS z FROM sized),{chain}
walk(r, seed, spot, next) AS (
  SELECT r, key::HUGEINT, -1::BIGINT, 0::BIGINT FROM sized
  UNION ALL
  SELECT r, s, next, floor(((next + 1) * 2147483648)::DOUBLE / ((s // 8589934592)::BIGINT + 1)::DOUBLE)::BIGINT
  FROM (SELECT r, next, (seed * {sharding.MULTIPLIER} + 1) % {sharding.MODULUS} AS s FROM walk WHERE next < {SHARDS + 1})),
done AS (
  SELECT r, doc_id, sized.n + 8 AS size, xor(xor(z, 4294967295), coalesce(x, 0)) AS crc, a.spot AS shard, g.spot AS grown
  FROM sized JOIN zero{levels} USING (r) LEFT JOIN block{levels} USING (r) JOIN {jump(SHARDS)} a USING (r) JOIN {jump(SHARDS + 1)} g USING (r)),
spread AS (SELECT *, {_md5_long("coalesce(doc_id::VARCHAR, '~') || ':' || size || ':' || crc || ':key:' || shard || ':' || grown")} % {sharding.BUCKETS} AS bucket FROM done)
SELECT doc_id, size, crc AS text_crc32, 'key' AS law, shard::INT AS shard, grown::INT AS grown_shard,
  row_number() OVER (PARTITION BY shard ORDER BY bucket, doc_id NULLS FIRST, size, crc) - 1 AS slot
FROM spread
"""


def quality_sql() -> str:
    q = quality
    share, miss = q.RISK / len(q.RULES), q.MISS / len(q.RULES)
    bins = {"symbols": "100 * n_symbols / greatest(n_words, 1)", "shouts": "100 * shouts / greatest(n_words, 1)", "capitals": "100 * capitals / greatest(word_chars, 1)",
            "repeats": "100 * n_repeat_words / greatest(n_words, 1)", "dup_lines": "100 * n_dup_lines / greatest(n_lines, 1)", "word_length": "10 * word_chars / greatest(n_words, 1)"}
    listed = ", ".join(f"least({q.BINS}, ceil({bins[r]}))::INT" for r in q.RULES)
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, lang, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, doc_id, lang, text, regexp_extract_all(text, '{_WORD}') AS words,
        list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{_WORD}')) AS lines FROM d),
windows AS (SELECT r, i, array_to_string(words[i:i + 7], ' ') AS win FROM (SELECT r, words, unnest(range(1, len(words) - 6)) AS i FROM w)),
twice AS (SELECT r, i FROM windows QUALIFY count(*) OVER (PARTITION BY r, win) > 1),
covered AS (SELECT r, sum(least(8, coalesce(nxt - i, 8)))::BIGINT AS n FROM (SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS nxt FROM twice) GROUP BY r),
m AS (SELECT w.r, doc_id, lang, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
        len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
        coalesce(covered.n, 0) AS n_repeat_words, len(lines) AS n_lines, len(regexp_extract_all(text, '[!?]')) AS shouts, len(regexp_extract_all(text, '\\p{{Lu}}')) AS capitals
      FROM w LEFT JOIN covered ON covered.r = w.r),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed, [{listed}] AS bins FROM m),
marks AS (SELECT doc_id, min(quality) AS good FROM labels WHERE quality IS NOT NULL AND doc_id IS NOT NULL GROUP BY doc_id),
cells AS (SELECT lang, rule, bins[rule + 1] AS bin, (good = 1)::INT AS good, (good <> 1)::INT AS bad FROM b JOIN marks USING (doc_id), range({len(q.RULES)}) x(rule) WHERE NOT base_failed),
counts AS (SELECT lang, rule, bin, sum(good) AS good, sum(bad) AS bad FROM cells GROUP BY ALL),
cuts AS (SELECT lang, rule, bin, sum(good) OVER g AS n, sum(bad) OVER g AS m, coalesce(sum(good) OVER up, 0) AS lost, coalesce(sum(bad) OVER up, 0) AS caught FROM counts
         WINDOW g AS (PARTITION BY lang, rule), up AS (PARTITION BY lang, rule ORDER BY bin DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
tails AS (SELECT n, k, sum(exp(lgamma(n + 1) - lgamma(k + 1) - lgamma(n - k + 1) + k * ln({share!r}) + (n - k) * ln({1 - share!r}))) OVER (PARTITION BY n ORDER BY k) AS tail
          FROM (SELECT n, unnest(range(0, ceil(n * {share!r})::BIGINT + 1)) AS k FROM (SELECT DISTINCT n FROM cuts))),
limits AS (SELECT n, sum((tail <= {miss!r} / (SELECT count(DISTINCT coalesce('x' || lang, '')) FROM cells))::INT) - 1 AS most FROM tails GROUP BY n),
gains AS (SELECT lang, rule, bin, caught / greatest(m, 1) - {q.LOSS_WEIGHT} * lost / greatest(n, 1) AS gain FROM cuts JOIN limits USING (n) WHERE lost <= most),
best AS (SELECT lang, rule, bin AS cut FROM gains WHERE gain > 0 QUALIFY row_number() OVER (PARTITION BY lang, rule ORDER BY gain DESC, bin DESC) = 1),
fired AS (SELECT r, string_agg({[*q.RULES]!r}[rule + 1], ',' ORDER BY rule) AS rejected_by FROM b JOIN best ON b.lang IS NOT DISTINCT FROM best.lang WHERE bins[rule + 1] > cut GROUP BY r)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND rejected_by IS NULL AS kept, coalesce(rejected_by, '') AS rejected_by
FROM b LEFT JOIN fired USING (r)
"""


JACCARD_SQL = f"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UP}', '{_LOW}'), '{_WORD}') AS w FROM documents),
sh AS (SELECT DISTINCT r, array_to_string(w[i:i + 2], ' ') AS s FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT r, count(*) AS n FROM sh GROUP BY r),
common AS (SELECT a.r AS a, b.r AS b, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.r < b.r GROUP BY ALL),
links AS (SELECT a, b FROM common JOIN n x ON x.r = a JOIN n y ON y.r = b WHERE 100 * c >= 90 * (x.n + y.n - c)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(a, b) AS (SELECT a, b FROM both_ways UNION SELECT reach.a, both_ways.b FROM reach JOIN both_ways ON reach.b = both_ways.a),
lowest AS (SELECT a AS r, min(e.doc_id) AS low FROM reach JOIN d e ON e.r = reach.b GROUP BY a)
SELECT doc_id, coalesce(n.n, 0) AS n_shingles, least(doc_id, low) AS component_id FROM d LEFT JOIN n USING (r) LEFT JOIN lowest USING (r)
"""

ORACLES: dict[str, str] = {
    "op1_url_filter": url_filter_sql(),
    "op2_mix_sources": mix_sql(),
    "op4_shards": shards_sql(),
    "op6_quality": quality_sql(),
    "op8_jaccard_join": JACCARD_SQL,
}
