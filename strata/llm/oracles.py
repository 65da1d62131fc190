"""DuckDB SQL for the queries of this package that SQL can express."""

from __future__ import annotations

from strata.llm import link_trust, merkle, mixing, search, sharding
from strata.llm.common import ROUNDS

_BLANK = r"[^\x20\x09-\x0D]+"


def _half(seed: str, step: str, half: str) -> str:
    return f"('0x' || md5('{seed}:{step}:' || ({half})::VARCHAR)[1:12])::BIGINT"


def _feistel(value: str, n: str, seed: str) -> str:
    """A scalar subquery: the permutation's rounds over the value."""
    a, b = f"ceil(sqrt(({n})::DOUBLE))::BIGINT", "q.b"
    inner = f"(SELECT {value} % {a} AS l, {value} // {a} AS r, {a} AS a, (({n}) + {a} - 1) // {a} AS b)"
    for i in range(ROUNDS):
        if i % 2 == 0:
            inner = f"(SELECT (l + {_half(seed, str(i), 'r')}) % a AS l, r, a, b FROM {inner} t{i})"
        else:
            inner = f"(SELECT l, (r + {_half(seed, str(i), 'l')}) % b AS r, a, b FROM {inner} t{i})"
    return f"(SELECT l + a * r FROM {inner} q)"


#: The checksum is worked out byte by byte, with this table of 256 numbers.
_CRC_TABLE = ("list_transform(range(256), lambda i: list_reduce([i] || range(8), lambda c, _: "
              "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END))")


def _crc32(text: str) -> str:
    return (f"xor(list_reduce([4294967295::BIGINT] || list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda h: ('0x' || h)::BIGINT), "
            "lambda c, x: xor(c >> 8, t[xor(c & 255, x) + 1])), 4294967295)")


def sharding_sql() -> str:
    """The walk back into the range is a recursion."""
    return f"""
WITH RECURSIVE crc_table AS (SELECT {_CRC_TABLE} AS t),
raw AS (SELECT doc_id, strlen(coalesce(text, '')) + 16 AS size, coalesce(text, '') AS text FROM documents),
digest AS (
  SELECT doc_id, size, CASE WHEN text = '' THEN 0::BIGINT ELSE {_crc32('text')} END::BIGINT AS text_crc32
  FROM raw, crc_table),
numbered AS (
  SELECT *, row_number() OVER (ORDER BY doc_id NULLS FIRST, text_crc32, size) - 1 AS n, count(*) OVER () AS total FROM digest),
walk AS (
  SELECT n, total, {_feistel('n', 'total', sharding.SEED)} AS p FROM numbered
  UNION ALL
  SELECT n, total, {_feistel('p', 'total', sharding.SEED)} FROM walk WHERE p >= total)
SELECT doc_id, size, text_crc32, 'rows' AS law, (p % {sharding.SHARDS})::INTEGER AS shard, (p // {sharding.SHARDS})::BIGINT AS slot,
       NULL::INTEGER AS grown_shard
FROM numbered JOIN walk USING (n) WHERE p < walk.total
"""


def mixing_sql() -> str:
    """Lists every quotient and takes the highest; water filling by trying every prefix."""
    words, most, least = mixing.BLOCK_WORDS, mixing.MAX_EPOCHS, mixing.LEAST_BLOCKS
    return f"""
WITH RECURSIVE docs AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{_BLANK}'))::BIGINT AS size, text FROM documents),
sizes AS (SELECT source, sum(size)::BIGINT AS source_size FROM docs GROUP BY source),
ranked AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank FROM sizes),
weighed AS (SELECT *, rank % 3 + 1 AS weight, {most} * source_size AS cap, greatest(ceil(source_size / {words}.0)::BIGINT, least(source_size, {least})) AS blocks FROM ranked),
levels AS (
  SELECT w.rank, coalesce(sum(o.cap) FILTER (WHERE o.cap * w.weight < w.cap * o.weight OR (o.cap * w.weight = w.cap * o.weight AND o.rank < w.rank)), 0) AS caps,
         coalesce(sum(o.weight) FILTER (WHERE o.cap * w.weight < w.cap * o.weight OR (o.cap * w.weight = w.cap * o.weight AND o.rank < w.rank)), 0) AS weights,
         any_value(w.cap) AS cap, any_value(w.weight) AS weight
  FROM weighed w, weighed o GROUP BY w.rank),
whole AS (SELECT sum(source_size) AS words, sum(weight) AS weights FROM weighed),
fit AS (
  SELECT (whole.words - caps)::BIGINT AS left_over, (whole.weights - levels.weights)::BIGINT AS share
  FROM levels, whole WHERE (whole.words - caps) * weight <= levels.cap * (whole.weights - levels.weights)
  ORDER BY caps, levels.weights LIMIT 1),
aimed AS (
  SELECT w.*, CASE WHEN f.share IS NULL OR w.cap * f.share < w.weight * f.left_over THEN w.cap::DOUBLE
              ELSE (w.weight * f.left_over)::DOUBLE / f.share::DOUBLE END AS target
  FROM weighed w LEFT JOIN fit f ON true),
claimed AS (SELECT *, CASE WHEN source_size > 0 THEN target * blocks / source_size ELSE 0 END AS claim FROM aimed),
house AS (SELECT CASE WHEN sum(claim) > 0 THEN greatest(1, floor(sum(claim) + 0.5))::BIGINT ELSE 0 END AS m FROM claimed),
quotients AS (
  SELECT rank, claim / (2 * k + 1) AS q FROM claimed, house, LATERAL (SELECT unnest(range({most} * blocks + 40)) AS k) u WHERE claim > 0),
won AS (SELECT rank, count(*) AS n FROM (SELECT rank FROM quotients ORDER BY q DESC, rank LIMIT (SELECT m FROM house)) GROUP BY rank),
seated AS (SELECT a.*, least(coalesce(won.n, 0), {most} * blocks)::BIGINT AS seats FROM aimed a LEFT JOIN won USING (rank)),
placed AS (
  SELECT d.doc_id, d.size, s.source_size, s.target, s.source, s.blocks, s.seats, s.rank,
         sum(d.size) OVER (PARTITION BY s.rank ORDER BY d.doc_id NULLS FIRST, d.size ROWS UNBOUNDED PRECEDING) - d.size AS start,
         row_number() OVER () AS line
  FROM docs d JOIN seated s ON d.source IS NOT DISTINCT FROM s.source),
every_block AS (SELECT rank, blocks, unnest(range(blocks)) AS block FROM seated),
walk AS (
  SELECT rank, block, blocks, {_feistel('block', 'blocks', mixing.SEED)} AS p FROM every_block
  UNION ALL
  SELECT rank, block, blocks, {_feistel('p', 'blocks', mixing.SEED)} FROM walk WHERE p >= blocks),
chosen AS (
  SELECT s.rank, w.block * (source_size // s.blocks) + least(w.block, source_size % s.blocks) AS begin,
         (w.block + 1) * (source_size // s.blocks) + least(w.block + 1, source_size % s.blocks) AS until
  FROM walk w JOIN seated s USING (rank) WHERE w.p < w.blocks AND w.p < s.seats % s.blocks),
part AS (
  SELECT p.line, sum(least(c.until, p.start + p.size) - greatest(c.begin, p.start)) AS words
  FROM placed p JOIN chosen c ON p.rank = c.rank AND c.begin < p.start + p.size AND c.until > p.start
  WHERE p.size > 0 GROUP BY p.line)
SELECT doc_id, size, source_size, target,
       ((CASE WHEN blocks > 0 THEN seats // blocks ELSE 0 END) * size + coalesce(part.words, 0))::BIGINT AS taken, source, blocks, seats
FROM placed LEFT JOIN part USING (line)
"""


def link_trust_sql() -> str:
    """A fixed number of rounds, by recursion. The host of no name is where all ranks restart: it
    keeps 1 of each and gives every seed its share."""
    m = link_trust
    rules = sorted(m.RULES, key=lambda r: -len(r[1] + r[2]))
    fits = lambda r: f"(host = '{r[1]}' OR host LIKE '%.{r[1]}') AND starts_with(path, '{r[2]}')"
    case = lambda value: "CASE " + " ".join(f"WHEN {fits(r)} THEN '{value(r)}'" for r in rules) + " END"
    low = lambda x: f"translate({x}, '{m.UPPER}', '{m.LOWER}')"
    link = m.LINK.replace("'", "''")
    return f"""
WITH RECURSIVE parts AS (
  SELECT page_id, html, {low(f"regexp_extract(coalesce(url, ''), '{m.URL}', 1)")} AS host, regexp_extract(coalesce(url, ''), '{m.URL}', 2) AS path FROM pages),
judged AS (SELECT page_id, host, path, {case(lambda r: r[1] + r[2])} AS rule, {case(lambda r: r[0])} AS ruled FROM parts),
counted AS (
  SELECT host, count(*) FILTER (WHERE ruled = 'allow') AS good, count(*) FILTER (WHERE ruled = 'block') AS bad
  FROM judged WHERE host <> '' AND ruled IS NOT NULL GROUP BY host),
linked AS (
  SELECT src, dst, count(*) AS n FROM (
    SELECT host AS src, {low('u')} AS dst FROM (SELECT host, unnest(regexp_extract_all(coalesce(html, ''), '{link}', 1)) AS u FROM parts WHERE host <> ''))
  WHERE src <> dst GROUP BY ALL),
hosts AS (SELECT DISTINCT string_split(host, '.') AS labels FROM (SELECT host FROM judged UNION ALL SELECT dst FROM linked) WHERE host <> ''),
steps AS (
  SELECT DISTINCT array_to_string(labels[i:], '.') AS a, array_to_string(labels[i + 1:], '.') AS b
  FROM (SELECT labels, unnest(range(1, len(labels) - 1)) AS i FROM hosts WHERE len(labels) > 2)),
weighed AS (SELECT a, b, 1.0::DOUBLE / count(*) OVER (PARTITION BY b) AS n FROM steps),
summed AS (
  SELECT src, dst, sum(n)::DOUBLE AS n FROM (SELECT * FROM linked UNION ALL SELECT a, b, n FROM weighed UNION ALL SELECT b, a, n FROM weighed) GROUP BY src, dst),
edges AS (
  SELECT src, dst, {m.DAMPING} * n / greatest(1, sum(n) OVER (PARTITION BY src)) AS along,
         {m.DAMPING} * n / greatest(1, sum(n) OVER (PARTITION BY dst)) AS back FROM summed),
every AS (SELECT host FROM counted UNION SELECT src FROM edges UNION SELECT dst FROM edges),
moves AS (
  SELECT src AS host, dst AS goal, along AS t, 0.0::DOUBLE AS d, 0.0::DOUBLE AS b FROM edges
  UNION ALL SELECT dst, src, 0, back, back FROM edges
  UNION ALL SELECT '', '', 1, 1, 1
  UNION ALL SELECT '', host, {1 - m.DAMPING} * coalesce(good, 0) / greatest((SELECT sum(good) FROM counted), 1),
                   {1 - m.DAMPING} * coalesce(bad, 0) / greatest((SELECT sum(bad) FROM counted), 1), {1 - m.DAMPING} / (SELECT count(*) FROM every)
            FROM every LEFT JOIN counted USING (host)),
ranks AS (
  SELECT 0 AS k, '' AS host, 1.0::DOUBLE AS t, 1.0::DOUBLE AS d, 1.0::DOUBLE AS b
  UNION ALL
  SELECT any_value(r.k) + 1, m.goal, sum(r.t * m.t), sum(r.d * m.d), sum(r.b * m.b) FROM ranks r JOIN moves m ON m.host = r.host WHERE r.k < 120 GROUP BY m.goal),
verdicts AS (
  SELECT host, CASE WHEN d > {m.THRESHOLD} * (t + d) + {m.MARGIN} * (t + d) AND d > {(1 + m.MARGIN) * m.FLOOR} * b THEN 'block' ELSE 'allow' END AS host_verdict
  FROM ranks WHERE k = 120 AND host <> '')
SELECT page_id, j.host, path, rule, coalesce(ruled, host_verdict, 'allow') AS verdict, coalesce(host_verdict, 'allow') AS host_verdict
FROM judged j LEFT JOIN verdicts v ON j.host = v.host
"""


def manifest_sql() -> str:
    """Levels by recursion; a node's siblings are its neighbours in a window over its run of three."""
    part = lambda c: f"coalesce(strlen({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR, '-')"
    head = " || ".join(part(c) for c in merkle.LEAF_COLUMNS[:-1])
    sides = """coalesce(lag(digest, 2) OVER r, '') || coalesce(lag(digest) OVER r, '') AS l,
         coalesce(lead(digest) OVER r, '') || coalesce(lead(digest, 2) OVER r, '') AS r"""
    return f"""
WITH RECURSIVE crc_table AS (SELECT {_CRC_TABLE} AS t),
raw AS (SELECT *, coalesce({_crc32('doc_id::VARCHAR')} % 2 = 0, false) AS hit FROM documents, crc_table),
leaves AS (
  SELECT doc_id, source, sha256({head} || {part('text')}) AS leaf,
         sha256({head} || CASE WHEN hit THEN {part("replace(text, chr(10), '')")} ELSE {part('text')} END) AS shown FROM raw),
placed AS (
  SELECT *, row_number() OVER () AS line, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
         count(*) OVER (PARTITION BY source) AS width, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree FROM leaves),
nodes AS (
  SELECT tree, 0 AS level, pos, width, leaf AS digest FROM placed
  UNION ALL
  SELECT tree, level + 1, pos // 3, (any_value(width) + 2) // 3, sha256(string_agg(digest, '' ORDER BY pos))
  FROM nodes WHERE width > 1 GROUP BY tree, level, pos // 3),
roots AS (SELECT tree AS pos, digest, count(*) OVER () AS width FROM nodes WHERE width = 1),
tops AS (
  SELECT 0 AS level, pos, width, digest FROM roots
  UNION ALL
  SELECT level + 1, pos // 3, (any_value(width) + 2) // 3, sha256(string_agg(digest, '' ORDER BY pos))
  FROM tops WHERE width > 1 GROUP BY level, pos // 3),
sides AS (SELECT tree, level, pos, {sides} FROM nodes WINDOW r AS (PARTITION BY tree, level, pos // 3 ORDER BY pos)),
top_sides AS (SELECT level, pos, {sides} FROM tops WINDOW r AS (PARTITION BY level, pos // 3 ORDER BY pos)),
up AS (
  SELECT line, tree, 0 AS level, pos, width, shown AS folded, '' AS proof FROM placed
  UNION ALL
  SELECT line, u.tree, u.level + 1, u.pos // 3, (width + 2) // 3, sha256(l || folded || r), proof || l || r
  FROM up u JOIN sides s ON s.tree = u.tree AND s.level = u.level AND s.pos = u.pos WHERE width > 1),
over AS (
  SELECT line, 0 AS level, tree AS pos, (SELECT count(*) FROM roots) AS width, folded, proof FROM up WHERE width = 1
  UNION ALL
  SELECT line, o.level + 1, o.pos // 3, (width + 2) // 3, sha256(l || folded || r), proof || l || r
  FROM over o JOIN top_sides s ON s.level = o.level AND s.pos = o.pos WHERE width > 1),
whole AS (SELECT digest AS root FROM tops WHERE width = 1)
SELECT p.doc_id, p.leaf, roots.digest AS subroot, root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = root AS verified
FROM placed p JOIN over o ON o.line = p.line AND o.width = 1 JOIN roots ON roots.pos = p.tree, whole
"""


def search_sql() -> str:
    """Every document scored for every item."""
    terms = rf"regexp_extract_all(translate(coalesce(text, ''), '{link_trust.UPPER}', '{link_trust.LOWER}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
    return f"""
WITH docs AS (SELECT * FROM (SELECT row_number() OVER () AS line, doc_id, {terms} AS terms FROM documents) WHERE len(terms) > 0),
whole AS (SELECT count(*)::BIGINT AS total, coalesce(sum(len(terms)), 0)::BIGINT AS terms FROM docs),
normed AS (SELECT line, doc_id, (75 + (25 * len(docs.terms)::BIGINT * total) // whole.terms)::BIGINT AS m FROM docs, whole),
asked AS (
  SELECT item, item_id, term, count(*)::BIGINT AS times
  FROM (SELECT item, item_id, unnest(terms) AS term FROM (SELECT row_number() OVER () AS item, item_id, {terms} AS terms FROM benchmark)) GROUP BY ALL),
tfs AS (SELECT line, term, count(*)::BIGINT AS tf FROM (SELECT line, unnest(terms) AS term FROM docs) WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
weights AS (
  SELECT term, floor(1000 * ln((2 * any_value(total) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM tfs, whole GROUP BY term),
scored AS (
  SELECT item, any_value(item_id) AS item_id, any_value(doc_id) AS doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
  FROM asked JOIN tfs USING (term) JOIN weights USING (term) JOIN normed USING (line) GROUP BY item, line),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS FIRST) AS rank FROM scored WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= {search.TOP_K}
"""


ORACLE: dict[str, str] = {
    "op1_link_trust": link_trust_sql(),
    "op2_feistel_sharding": sharding_sql(),
    "op4_sainte_lague_mixing": mixing_sql(),
    "op11_length_stratified_search": search_sql(),
    "op13_octopus_manifest": manifest_sql(),
}
