"""URL filters (6): a temporal join of captures with dated list entries.

An entry (list, kind, pattern, action, dated_at) holds from its date until the
next entry of the same list, kind and pattern, so that entries become validity
intervals; ``remove`` ends one without starting another.  A capture is matched
with the entries that held when it was fetched, not with those of today: each
of its keys (its host; its host and all parent domains; its host with all
leading path segments) is joined on kind and pattern, as of the fetch time.

An active ``allow`` outweighs any ``block``.  The answer names the deciding
entry: the longest pattern, then the first list, kind and pattern in order.

Everything is DataFrame operations.  Captures are reduced to distinct URLs and
times before keys are made, so that repeated captures cost once.  Keys that no
entry has ever listed are dropped when keys are counted, and the HOT patterns
that most captures share are joined in SALTS parts each, so that ``com`` isn't
one task; answers are combined per URL and time with partial aggregation, and no
group is gathered.

Defined cases: null, empty or malformed URLs, and captures without a time, match
nothing and get ``none``; entries with a null field are ignored; of entries of
the same list, kind, pattern and date ``allow`` counts before ``block`` before
``remove``; repeated captures get the same answer; very long URLs have one key
per path segment; empty tables give an empty result or ``none``; columns of the
captures are kept, those with the added names replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from starloom.llm import urls

ADDED = ("host", "verdict", "n_active", "list", "pattern")
#: Patterns whose captures are spread, and over how many parts.
HOT, SALTS = 4_096, 64
_RANK = {"remove": 0, "block": 1, "allow": 2}


def intervals(entries: DataFrame) -> DataFrame:
    """list, kind, pattern, action, valid_from, valid_to (null: still valid), without what was removed."""
    key = ["list", "kind", "pattern"]
    rank = F.coalesce(*[F.when(F.col("action") == a, F.lit(r)) for a, r in _RANK.items()])
    known = entries.select(*key, rank.alias("rank"), F.col("dated_at").alias("valid_from")).dropna()
    one = known.groupBy(*key, "valid_from").agg(F.max("rank").alias("rank"))
    dated = one.withColumn("valid_to", F.lead("valid_from").over(Window.partitionBy(*key).orderBy("valid_from")))
    return dated.where("rank > 0").select(*key, F.when(F.col("rank") == 2, "allow").otherwise("block").alias("action"), "valid_from", "valid_to")


def _keys(host, path):
    """(kind, pattern) of everything that may be listed for a URL."""
    labels = F.split(host, "\\.")
    domains = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.struct(F.lit("domain").alias("kind"), F.concat_ws(".", F.slice(labels, i, F.size(labels))).alias("pattern")))
    steps = F.filter(F.split(path, "/"), lambda x: x != "")
    paths = F.transform(F.when(F.size(steps) > 0, F.sequence(F.lit(1), F.size(steps))).otherwise(F.array().cast("array<int>")), lambda i: F.struct(F.lit("path").alias("kind"), F.concat(host, F.lit("/"), F.concat_ws("/", F.slice(steps, F.lit(1), i))).alias("pattern")))
    return F.concat(F.array(F.struct(F.lit("host").alias("kind"), host.alias("pattern"))), domains, paths)


def filter_urls(captures: DataFrame, entries: DataFrame, url_col: str = "url", time_col: str = "fetched_at") -> DataFrame:
    """``captures`` with host, verdict (allow, block, none), n_active, list and pattern."""
    asked = captures.select(F.col(url_col).alias("u"), F.col(time_col).alias("t")).dropna().distinct().withColumn("h", urls.host(F.col("u"))).where("h != ''")
    keyed = asked.select("u", "t", F.explode(_keys(F.col("h"), urls.path(F.col("u")))).alias("k")).select("u", "t", "k.kind", "k.pattern")
    held = intervals(entries)
    listed = held.select(F.col("kind").alias("a"), F.col("pattern").alias("b")).distinct()
    met = keyed.groupBy("kind", "pattern").agg(F.count("*").alias("n")).join(listed, (F.col("kind") == F.col("a")) & (F.col("pattern") == F.col("b")))
    hot = F.broadcast(met.orderBy(F.desc("n"), "kind", "pattern").limit(HOT).select("a", "b"))  # HOT rows at the most
    dealt = F.pmod(F.xxhash64("u", "t"), F.lit(SALTS)).cast("int")
    keyed = keyed.join(hot, (F.col("kind") == F.col("a")) & (F.col("pattern") == F.col("b")), "left").select("u", "t", "kind", "pattern", F.when(F.col("a").isNotNull(), dealt).otherwise(0).alias("part"))
    parts = F.when(F.col("a").isNotNull(), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    held = held.select(*[F.col(c).alias(f"e_{c}") for c in held.columns])
    held = held.join(hot, (F.col("e_kind") == F.col("a")) & (F.col("e_pattern") == F.col("b")), "left").withColumn("e_part", F.explode(parts)).drop("a", "b")
    on = (F.col("kind") == F.col("e_kind")) & (F.col("pattern") == F.col("e_pattern")) & (F.col("part") == F.col("e_part"))
    on = on & (F.col("t") >= F.col("e_valid_from")) & (F.col("e_valid_to").isNull() | (F.col("t") < F.col("e_valid_to")))
    entry = F.struct((F.col("e_action") != "allow").alias("no"), (-F.length("e_pattern")).alias("short"), F.col("e_list").alias("list"), F.col("e_kind").alias("kind"), F.col("e_pattern").alias("pattern"))
    hit = keyed.join(held, on).select("u", "t", entry.alias("e"))
    found = hit.groupBy("u", "t").agg(F.count("*").alias("n"), F.min("e").alias("e"))
    kept = [c for c in captures.columns if c not in ADDED]
    out = captures.join(found, (captures[url_col] == found["u"]) & (captures[time_col] == found["t"]), "left")
    return out.select(
        *[captures[c] for c in kept],
        urls.host(captures[url_col]).alias("host"),
        F.when(found["n"].isNull(), "none").when(found["e"]["no"], "block").otherwise("allow").alias("verdict"),
        F.coalesce(found["n"], F.lit(0)).alias("n_active"),
        found["e"]["list"].alias("list"),
        found["e"]["pattern"].alias("pattern"),
    )
