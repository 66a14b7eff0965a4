"""One query per operator, over the whole intended table, and the SQL of those that SQL can express.

Each query only applies its operator with production parameters and derives
the columns that its contract names.
"""

from __future__ import annotations

from functools import reduce

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm import bpe, conversation_repair, decontamination, langid, line_quality, ngram_join, ppm, sharding, source_audit, topk, toxicity, url_filters, urls, warc
from starloom.llm.common import read


def op1_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Every document and benchmark item that match, with the best window."""
    found = decontamination.leaks(read(spark, folder, "documents"), read(spark, folder, "benchmark"))
    return found.select("doc_id", "item_id", "start", "similarity")


def op2_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """The shard of every document."""
    docs = read(spark, folder, "documents").select("doc_id", "source", "n_chars")
    return sharding.place(docs, ["doc_id"])


def op3_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with its shingle count, component and number of links."""
    return ngram_join.ngram_join(read(spark, folder, "documents"))


def op4_ppm(spark: SparkSession, folder: str) -> DataFrame:
    """Log10 probability of every document, learnt from six of seven folds."""
    return ppm.held_out_scores(read(spark, folder, "documents"))


def op5_langid(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every document, learnt from four of five folds."""
    return langid.predictions(read(spark, folder, "documents"))

#: The list history is derived from the hosts and paths of the pages, and dates from hashes; days count from 2024-01-01.
_DAY_0, _DAY = 1_704_067_200, 86_400


def _hashed(text):
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long")


def _captures(pages: DataFrame) -> DataFrame:
    """Pages with a fetch time in 2024, in seconds."""
    return pages.select("page_id", "url", (F.lit(_DAY_0) + F.pmod(F.pmod(F.col("page_id"), F.lit(525_600)) * 7919, F.lit(525_600)) * 60).alias("fetched_at"))


def _list_history(pages: DataFrame) -> DataFrame:
    """Entries of four lists: blocked, unblocked and blocked again hosts, domains, paths, and trusted hosts."""
    hosts = pages.select(urls.host(F.col("url")).alias("x"), urls.path(F.col("url")).alias("p")).where("x != ''").distinct()
    one = hosts.select("x").distinct().withColumn("k", _hashed(F.col("x")))
    domain = hosts.select(F.regexp_extract("x", "([^.]+[.][^.]+)$", 1).alias("x")).where("x != ''").distinct().withColumn("k", _hashed(F.col("x")))
    path = hosts.select(F.concat("x", F.lit("/"), F.regexp_extract("p", "^/*([^/]+)", 1)).alias("x")).where("x not like '%/'").distinct().withColumn("k", _hashed(F.col("x")))

    def entry(frame, name, kind, action, when, day):
        return frame.where(when).select(F.lit(name).alias("list"), F.lit(kind).alias("kind"), F.col("x").alias("pattern"), F.lit(action).alias("action"), (F.lit(_DAY_0) + F.expr(day) * _DAY).alias("dated_at"))

    parts = [
        entry(one, "abuse", "host", "block", "k % 3 = 0", "k % 200"),
        entry(one, "abuse", "host", "remove", "k % 6 = 0", "k % 200 + 40"),
        entry(one, "abuse", "host", "block", "k % 12 = 0", "k % 200 + 90"),
        entry(one, "gambling", "host", "block", "x rlike 'casino|bets'", "60"),
        entry(domain, "brands", "domain", "block", "k % 4 = 1", "k % 300"),
        entry(domain, "brands", "domain", "remove", "k % 8 = 1", "k % 300 + 30"),
        entry(path, "paths", "path", "block", "k % 5 = 2", "k % 250"),
        entry(one, "trusted", "host", "allow", "k % 10 = 3", "k % 100"),
    ]
    return reduce(DataFrame.unionByName, parts)


def op6_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    """Every page with the verdict of the lists as they stood when it was fetched."""
    pages = read(spark, folder, "pages")
    return url_filters.filter_urls(_captures(pages), _list_history(pages)).drop("url")


def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity score of every document, learnt from labelled rows of four of five folds."""
    return toxicity.scores(read(spark, folder, "documents"), read(spark, folder, "labels"))


def op8_topk(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 best of all vectors for every 20th vector."""
    return topk.top_k(read(spark, folder, "embeddings"))


def op9_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Every document encoded and decoded with the 49k word vocabulary."""
    vocab = public_tokenizers.path("word_bpe_49k.json")
    return bpe.digests(bpe.round_trip(read(spark, folder, "documents"), vocab))


def op10_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Every page written as a WARC record and read back."""
    return warc.round_trip(read(spark, folder, "pages"))


def op11_source_audit(spark: SparkSession, folder: str) -> DataFrame:
    """How far every source of a language is from every other, and its most overused terms."""
    return source_audit.audit(read(spark, folder, "documents"))


def op12_line_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's measures and the verdict of the base and line frequency rules."""
    return line_quality.verdicts(read(spark, folder, "documents")).withColumn("lines_gone", F.size("lines_gone").cast("long"))


def op13_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    """The damaged conversations' faults, cheapest edits and repaired digest."""
    given = read(spark, folder, "conversations")
    return conversation_repair.repair(conversation_repair.damage(given), every=given)


QUERIES = {
    "op1_decontamination": op1_decontamination,
    "op2_sharding": op2_sharding,
    "op3_ngram_join": op3_ngram_join,
    "op4_ppm": op4_ppm,
    "op5_langid": op5_langid,
    "op6_url_filters": op6_url_filters,
    "op7_toxicity": op7_toxicity,
    "op8_topk": op8_topk,
    "op9_bpe": op9_bpe,
    "op10_warc": op10_warc,
    "op11_source_audit": op11_source_audit,
    "op12_line_quality": op12_line_quality,
    "op13_conversation_repair": op13_conversation_repair,
}

_OP6_HOST = "rtrim(lower(regexp_extract(coalesce(url, ''), '" + urls.HOST + "', 1)), '.')"
_OP6_PATH = "regexp_extract(coalesce(url, ''), '" + urls.PATH + "', 1)"
_OP6 = f"""
WITH cap AS (SELECT page_id, url, {_OP6_HOST} AS host, {_OP6_PATH} AS path,
                    {_DAY_0} + ((page_id % 525600 * 7919) % 525600) * 60 AS fetched_at FROM pages),
hosts AS (SELECT DISTINCT host AS x FROM cap WHERE host <> ''),
one AS (SELECT x, ('0x' || substr(md5(x), 1, 8))::BIGINT AS k FROM hosts),
domain AS (SELECT x, ('0x' || substr(md5(x), 1, 8))::BIGINT AS k FROM (SELECT DISTINCT regexp_extract(x, '([^.]+[.][^.]+)$', 1) AS x FROM hosts) WHERE x <> ''),
path AS (SELECT x, ('0x' || substr(md5(x), 1, 8))::BIGINT AS k
         FROM (SELECT DISTINCT host || '/' || regexp_extract(path, '^/*([^/]+)', 1) AS x FROM cap WHERE host <> '') WHERE x NOT LIKE '%/'),
entries AS (
  SELECT 'abuse' AS list, 'host' AS kind, x AS pattern, 1 AS rank, k % 200 AS day FROM one WHERE k % 3 = 0
  UNION ALL SELECT 'abuse', 'host', x, 0, k % 200 + 40 FROM one WHERE k % 6 = 0
  UNION ALL SELECT 'abuse', 'host', x, 1, k % 200 + 90 FROM one WHERE k % 12 = 0
  UNION ALL SELECT 'gambling', 'host', x, 1, 60 FROM one WHERE regexp_matches(x, 'casino|bets')
  UNION ALL SELECT 'brands', 'domain', x, 1, k % 300 FROM domain WHERE k % 4 = 1
  UNION ALL SELECT 'brands', 'domain', x, 0, k % 300 + 30 FROM domain WHERE k % 8 = 1
  UNION ALL SELECT 'paths', 'path', x, 1, k % 250 FROM path WHERE k % 5 = 2
  UNION ALL SELECT 'trusted', 'host', x, 2, k % 100 FROM one WHERE k % 10 = 3),
held AS (SELECT list, kind, pattern, rank, {_DAY_0} + day * {_DAY} AS a,
                {_DAY_0} + lead(day) OVER (PARTITION BY list, kind, pattern ORDER BY day) * {_DAY} AS b
         FROM (SELECT list, kind, pattern, day, max(rank) AS rank FROM entries GROUP BY ALL)),
steps AS (SELECT *, list_filter(string_split(path, '/'), lambda s: s <> '') AS s, string_split(host, '.') AS l FROM cap WHERE host <> ''),
keys AS (
  SELECT DISTINCT url, fetched_at, 'host' AS kind, host AS pattern FROM steps
  UNION ALL SELECT DISTINCT url, fetched_at, 'domain', array_to_string(l[i:], '.') FROM steps, unnest(range(1, len(l) + 1)) AS r(i)
  UNION ALL SELECT DISTINCT url, fetched_at, 'path', host || '/' || array_to_string(s[1:i], '/') FROM steps, unnest(range(1, len(s) + 1)) AS r(i)),
hit AS (SELECT url, fetched_at, h.list, h.kind, h.pattern, h.rank,
               row_number() OVER (PARTITION BY url, fetched_at ORDER BY h.rank DESC, length(h.pattern) DESC, h.list, h.kind, h.pattern) AS place,
               count(*) OVER (PARTITION BY url, fetched_at) AS n
        FROM keys k JOIN held h ON h.kind = k.kind AND h.pattern = k.pattern AND h.rank > 0 AND k.fetched_at >= h.a AND (h.b IS NULL OR k.fetched_at < h.b))
SELECT c.page_id, c.fetched_at, c.host,
       CASE WHEN n IS NULL THEN 'none' WHEN rank = 2 THEN 'allow' ELSE 'block' END AS verdict,
       coalesce(n, 0) AS n_active, list, pattern
FROM cap c LEFT JOIN hit ON hit.url = c.url AND hit.fetched_at = c.fetched_at AND hit.place = 1
"""

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

# every group against every kept term, in full
_OP11 = rf"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
tok AS (SELECT r, lang, source, {_LOWER.format("x")} AS term FROM d, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS u(x)),
kept AS (SELECT lang, term FROM tok GROUP BY ALL HAVING count(DISTINCT r) >= 30),
groups AS (SELECT DISTINCT lang, source FROM d),
n AS (SELECT lang, source, term, count(*) AS n FROM tok GROUP BY ALL),
cell AS (SELECT g.lang, g.source, k.term, coalesce(n.n, 0)::HUGEINT AS n FROM groups g JOIN kept k USING (lang) LEFT JOIN n USING (lang, source, term)),
p AS (SELECT lang, source, term, n, 1 + (1000000000 * (n + 5)) // (sum(n) OVER g + 5 * count(*) OVER g) AS p FROM cell WINDOW g AS (PARTITION BY lang, source)),
q AS (SELECT lang, term, 1 + (1000000000 * (n + 5)) // (sum(n) OVER (PARTITION BY lang) + 5 * count(*) OVER (PARTITION BY lang)) AS q
      FROM (SELECT lang, term, sum(n) AS n FROM cell GROUP BY ALL)),
found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(sum(abs(x.p - y.p)), 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN p x ON x.lang = a.lang AND x.source = a.source LEFT JOIN p y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
  GROUP BY ALL
  UNION ALL SELECT lang, source, 'term', term, p - q FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM found)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM ranked WHERE part = 'pair' OR rank <= 50
"""

# windows of words and lines compared as they are, none by hash
_OP12 = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(source, '') AS host, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, doc_id, host, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM d),
pos AS (SELECT r, unnest(w) AS a, generate_subscripts(w, 1) AS i FROM w),
next AS (SELECT r, i, a, lead(a, 1) OVER o AS b, lead(a, 2) OVER o AS c, lead(a, 3) OVER o AS d, lead(a, 4) OVER o AS e FROM pos WINDOW o AS (PARTITION BY r ORDER BY i)),
win AS (SELECT r, i, count(*) OVER (PARTITION BY r, a, b, c, d, e) AS n FROM next WHERE e IS NOT NULL),
rep AS (SELECT r, count(DISTINCT i + k) AS n FROM win, range(5) AS o(k) WHERE n > 1 GROUP BY r),
ln AS (SELECT r, doc_id, host, unnest(string_split(text, chr(10))) AS raw FROM w),
lw AS (SELECT r, doc_id, host, raw, regexp_replace({_LOWER.format("array_to_string(regexp_extract_all(raw, '[^\\x20\\x09-\\x0D]+'), ' ')")}, '[1-9]', '0', 'g') AS line,
              len(regexp_extract_all(raw, '[^\x20\x09-\x0D]+')) AS words FROM ln),
here AS (SELECT * FROM lw WHERE words > 0),
dup AS (SELECT r, count(*) - count(DISTINCT raw) AS n FROM here GROUP BY r),
hosts AS (SELECT host, count(DISTINCT doc_id) + max((doc_id IS NULL)::INT) AS docs FROM d GROUP BY host),
frequent AS (SELECT host, line FROM (SELECT host, line, count(DISTINCT doc_id) + max((doc_id IS NULL)::INT) AS n FROM here GROUP BY ALL) JOIN hosts USING (host)
             WHERE n > 10 AND n * 1000 > docs),
gone AS (SELECT r, sum(words) AS words, count(*) AS n FROM here JOIN frequent USING (host, line) GROUP BY r),
m AS (SELECT w.doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars, length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
             coalesce(dup.n, 0)::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words, (len(w) - coalesce(gone.words, 0))::BIGINT AS words_left, coalesce(gone.n, 0)::BIGINT AS lines_gone
      FROM w LEFT JOIN dup USING (r) LEFT JOIN rep USING (r) LEFT JOIN gone USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND words_left >= 10 AND 2 * words_left >= n_words AS kept, words_left, lines_gone
FROM m
"""



def _edit(rest: str, price: str, letter: str, line: str) -> str:
    """An edit before others: a string of nine digits of cost, the edits' initials, a mark and the rows."""
    return f"lpad((substr({rest}, 1, 9)::INT + {price})::VARCHAR, 9, '0') || '{letter}' || substr({rest}, 10, instr({rest}, chr(1)) - 10) || chr(1) || {line} || substr({rest}, instr({rest}, chr(1)) + 1)"


def _row_edits(state: int) -> str:
    """The least of a row's edits in a state (0 nothing, 1 system, 2 user, 3 assistant)."""
    to, role, initial = (3, "assistant", "a") if state == 2 else (2, "user", "u")
    drop = _edit(f"s{state}", "2", "D", "''")
    change = _edit(f"s{to}", "1 + cut", "R", f"'{role}:' || text || chr(10)")
    keep = f"CASE WHEN left(role, 1) = '{initial}' THEN {_edit(f's{to}', 'cut', 'K', "role || ':' || text || chr(10)")} END"
    first = f", CASE WHEN left(role, 1) = 's' THEN {_edit('s1', 'cut', 'K', "role || ':' || text || chr(10)")} END" if state == 0 else ""
    return f"CASE WHEN gone THEN {drop} ELSE least({drop}, {change}, {keep}{first}) END AS b{state}"


_CRC32 = "list_reduce([4294967295] || list_transform(string_split({}, ''), lambda c: ascii(c)::BIGINT), lambda a, c: list_reduce([xor(a, c)] || range(8), lambda x, k: xor(x // 2, 3988292384 * (x % 2))))"

# the edits of the rest of a conversation from each of the four states, row by row from its end
_OP13 = rf"""
WITH RECURSIVE g AS (SELECT dense_rank() OVER (ORDER BY conv_id) AS c, conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
       xor({_CRC32.format("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")}, 4294967295) % 20 AS kind FROM conversations),
d AS (SELECT c, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role, CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
      FROM g, unnest(CASE kind WHEN 0 THEN [] WHEN 3 THEN [1, 2] ELSE [1] END)),
o AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, sha256(text)) AS i, regexp_replace(text, '[\x20\x09-\x0D]+$', '') AS bare FROM d),
f AS (SELECT *, bare = '' AS blank, bare <> '' AND row_number() OVER (PARTITION BY c, role, text ORDER BY i) > 1 AS again, lag(left(role, 1)) OVER (PARTITION BY c ORDER BY i) || left(role, 1) AS two FROM o),
r AS (SELECT c, i, turn, role, text, blank, again, blank OR again AS gone, NOT blank AND NOT again AND right(bare, 1) NOT IN ('.', '!', '?') AS short,
             CASE WHEN short THEN 5 ELSE 0 END AS cut, coalesce(two NOT IN ('su', 'ua', 'au'), false) AS wrong FROM f),
k AS (SELECT c, conv_id FROM g GROUP BY ALL),
n AS (SELECT k.c, conv_id, count(i) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank, count(*) FILTER (again) AS duplicate,
             count(*) FILTER (short) AS truncated, count(*) FILTER (wrong) AS illegal FROM k LEFT JOIN r ON r.c = k.c GROUP BY ALL),
go(c, i, s0, s1, s2, s3) AS (
  SELECT c, n, '000000000' || chr(1), '000000010II' || chr(1) || 'user:' || chr(10) || 'assistant:' || chr(10), '000000005I' || chr(1) || 'assistant:' || chr(10), '000000000' || chr(1) FROM n
  UNION ALL
  SELECT c, i, least(b0, {_edit("n2", "5", "I", "'user:' || chr(10)")}), least(b1, {_edit("n2", "5", "I", "'user:' || chr(10)")}), n2, least(b3, {_edit("b2", "5", "I", "'user:' || chr(10)")})
  FROM (SELECT *, least(b2, {_edit("b3", "5", "I", "'assistant:' || chr(10)")}) AS n2
        FROM (SELECT go.c, go.i - 1 AS i, {", ".join(_row_edits(x) for x in range(4))} FROM go JOIN r ON r.c = go.c AND r.i = go.i WHERE go.i > 0)))
SELECT conv_id, gaps, blank, duplicate, truncated, illegal, substr(s0, 1, 9)::BIGINT AS cost, substr(s0, 10, instr(s0, chr(1)) - 10) AS audit,
       sha256(regexp_replace(substr(s0, instr(s0, chr(1)) + 1), '\n$', '')) AS repaired_sha256
FROM n JOIN go ON go.c = n.c AND go.i = 0
"""

SQL: dict[str, str] = {
    "op6_url_filters": _OP6,
    "op11_source_audit": _OP11,
    "op12_line_quality": _OP12,
    "op13_conversation_repair": _OP13,
}
