"""URL rules and host lists by a cascade of Bloom filters.

Level 0 encodes the listed keys, level 1 those keys of the corpus that level 0 wrongly accepts, level 2 the listed keys that level 1
wrongly accepts, and so on until a level accepts nothing wrong. Over the corpus's complete key universe membership is exact and needs no
join: each filter is one array, read as a scalar subquery. Longer lists are dealt by a hash to several cascades of bounded size, which are
read one after another.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._store import Store

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MAX_FILTER_BYTES = 8 << 20  # of a shard
LEVEL0 = (10, 4)  # bits a key, probes
LATER = (2, 1)
MOST_LABELS = 127  # of a host name; what is listed with more goes by an equi-join


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (after the first ://, A-Z lower-cased) and path (before ? or #); both empty for null or without ://."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER)
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def host_suffix(host: Column, labels: int) -> Column:
    """The last ``labels`` labels of the host, null if it has fewer."""
    dots = F.length(host) - F.length(F.replace(host, F.lit("."), F.lit("")))
    return F.when((F.length(host) > 0) & (dots >= labels - 1), F.substring_index(host, ".", -labels))


def _probe(words: Column, n_words: int, key: Column, level: int, probes: int) -> Column:
    """Whether all of the key's bits are set."""
    ok = F.lit(True)
    for j in range(probes):
        bit = F.pmod(F.xxhash64(key, F.lit(level * 16 + j)), F.lit(n_words * 64))
        ok &= F.call_function("shiftrightunsigned", F.get(words, F.shiftright(bit, 6).cast("int")), (bit % 64).cast("int")).bitwiseAND(F.lit(1)) == 1
    return ok


def _filter(store: Store, keys: DataFrame, n: int, level: int, name: str) -> tuple[DataFrame, int, int]:
    """One row with the filter's words; how many words and probes it has."""
    bits, probes = LATER if level else LEVEL0
    n_words = max(1, -(-n * bits // 64))
    at = F.explode(F.array(*(F.pmod(F.xxhash64("key", F.lit(level * 16 + j)), F.lit(n_words * 64)) for j in range(probes))))
    put = keys.select(at.alias("bit")).select(F.shiftright("bit", 6).alias("w"), F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("bit") % 64).cast("int")).alias("v"))
    dense = put.unionAll(keys.sparkSession.range(n_words).select(F.col("id").alias("w"), F.lit(0).cast("long").alias("v")))
    words = dense.groupBy("w").agg(F.bit_or("v").alias("v")).agg(F.transform(F.array_sort(F.collect_list(F.struct("w", "v"))), lambda s: s["v"]).alias("words"))
    return store.put(words, name), n_words, probes


class Cascade:
    """Exact membership in ``listed`` (column key) for every key of ``universe`` (column key).

    Keys are dealt by a hash to as many shards as keep the filters of one below ``max_bytes`` about; each shard is a cascade of its own,
    and only one shard's filters are in a plan at a time.
    """

    def __init__(self, spark: SparkSession, universe: DataFrame, listed: DataFrame, max_bytes: int = MAX_FILTER_BYTES):
        self.store = store = Store(spark)
        keys = universe.select("key", F.lit(False).alias("on")).unionAll(listed.select("key", F.lit(True).alias("on")))
        keys = store.put(keys.where(F.col("key").isNotNull()).groupBy("key").agg(F.max("on").alias("on")), "keys")
        n_on, n_off = keys.agg(F.count_if("on"), F.count_if(~F.col("on"))).first()
        #: Level 0 and, for the hundredth of the others that it wrongly accepts, level 1.
        self.n_shards = max(1, -(-(n_on * LEVEL0[0] + n_off * LATER[0] // 50) // (8 * max_bytes)))
        self.shards = [self._levels(keys.where(self._mine(F.col("key"), s)), f"shard{s}") for s in range(self.n_shards)]
        self.levels = self.shards[0]

    def _mine(self, key: Column, shard: int) -> Column:
        return F.lit(True) if self.n_shards == 1 else F.pmod(F.xxhash64(key, F.lit(-1)), F.lit(self.n_shards)) == shard

    def _levels(self, keys: DataFrame, name: str) -> list[tuple[DataFrame, int, int]]:
        out: list[tuple[DataFrame, int, int]] = []
        take, against = keys.where("on").select("key"), keys.where(~F.col("on")).select("key")
        n = take.count()
        while n:
            level = len(out)
            words, n_words, probes = _filter(self.store, take, n, level, f"{name}level{level}")
            out.append((words, n_words, probes))
            wrong = self.store.put(against.where(_probe(words.scalar(), n_words, F.col("key"), level, probes)), f"{name}wrong{level}")
            take, against, n = wrong, take, wrong.count()
        return out

    def contains(self, key: Column, shard: int = 0) -> Column:
        """True for listed keys of the shard: the first level that rejects a key decides."""
        levels = self.shards[shard]
        out = F.lit(len(levels) % 2 == 1)
        for level in reversed(range(len(levels))):
            words, n_words, probes = levels[level]
            out = F.when(_probe(words.scalar(), n_words, key, level, probes), out).otherwise(F.lit(level % 2 == 1))
        return key.isNotNull() & self._mine(key, shard) & out

    def mark(self, df: DataFrame, keys: dict[str, Column]) -> DataFrame:
        """``df`` with a flag for each of ``keys``; one pass over ``df`` for each shard."""
        for shard in range(self.n_shards):
            old = (lambda c: F.col(c)) if shard else (lambda c: F.lit(False))
            df = df.withColumns({c: old(c) | self.contains(k, shard) for c, k in keys.items()})
            if self.n_shards > 1:
                df = self.store.put(df, f"marked{shard}")
                if shard:
                    self.store.drop(f"marked{shard - 1}")
        return df


def _deep_hits(split: DataFrame, names: DataFrame) -> DataFrame:
    """host: those of ``split`` that are, or lie under, one of ``names`` with more than MOST_LABELS labels."""
    n = F.size(F.split("host", "\\."))
    ends = F.transform(F.sequence(F.lit(MOST_LABELS + 1), n), lambda k: F.call_function("substring_index", F.col("host"), F.lit("."), -k))
    own = split.select("host").distinct().where(n > MOST_LABELS).select("host", F.explode(ends).alias("end"))
    return own.join(names.where(n > MOST_LABELS).select(F.col("host").alias("end")), "end").select("host").distinct()


def filter_urls(pages: DataFrame, rules: list[tuple[str, str, str]], blocked: DataFrame | None = None, max_bytes: int = MAX_FILTER_BYTES) -> DataFrame:
    """The columns of ``pages`` plus host, path, rule and verdict.

    rules: (verdict, host, path); a rule fits its host and subdomains if the path starts with the rule's; the longest wins, of equally long
    ones the longer host. ``blocked`` (column host) lists hosts whose urls, subdomains included, are blocked where no rule fits; the rest
    is allowed. A null url, or one without ://, has empty host and path and is allowed. Repeated rows stay; an empty table gives no rows.
    Columns of ``pages`` named as a result are replaced.
    """
    spark = pages.sparkSession
    kept = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    host, path = split_url(F.col("url"))
    split = pages.select(*kept, host.alias("host"), path.alias("path"))
    shapes = sorted({(-(len(h) + len(p)), -len(h), h.count(".") + 1, len(p), v) for v, h, p in rules})
    shapes = list(dict.fromkeys((n, size, v) for _, _, n, size, v in shapes))
    #: Each shape is one form of key that a rule can have: so many labels, so long a path.
    at = {s: F.when(F.length("path") >= s[1], F.concat(F.lit(f"{s[2]}|"), host_suffix(F.col("host"), s[0]), F.substring("path", 1, s[1]))) for s in shapes}
    listed = spark.createDataFrame([(f"{v}|{h}{p}",) for v, h, p in rules] or [("",)], "key string").where("key <> ''")
    depths: list[int] = []
    deep = None
    if blocked is not None:
        names = blocked.select(F.translate("host", UPPER, LOWER).alias("host")).where("host <> ''").distinct()
        listed = listed.unionAll(names.select(F.concat(F.lit("list|"), "host")))
        every = sorted(r[0] for r in names.select((F.size(F.split("host", "\\."))).alias("n")).distinct().collect())
        depths = [n for n in every if n <= MOST_LABELS]
        if len(depths) < len(every):
            deep = _deep_hits(split, names)
    lists = [F.concat(F.lit("list|"), host_suffix(F.col("host"), n)) for n in depths]
    candidates = [*at.values(), *lists]
    if not candidates and deep is None:
        return split.select("*", F.lit(None).cast("string").alias("rule"), F.lit("allow").alias("verdict"))
    candidates = candidates or [F.lit(None).cast("string")]
    universe = split.select("host", "path").distinct().select(F.explode(F.array(*candidates)).alias("key")).where("key is not null").distinct()
    flags = {f"__hit{j}": k for j, k in enumerate(candidates)}
    split = Cascade(spark, universe, listed, max_bytes).mark(split, flags)
    hits = [F.col(c) for c in flags]
    fits = F.coalesce(*(F.when(h, F.struct(F.substring(k, len(s[2]) + 2, 1 << 20).alias("rule"), F.lit(s[2]).alias("verdict"))) for h, (s, k) in zip(hits, at.items(), strict=False)), F.lit(None).cast("struct<rule:string,verdict:string>"))
    hit = F.lit(False)
    for h in hits[len(at) :]:
        hit |= h
    if deep is not None:
        split = split.join(deep.select("host", F.lit(True).alias("__deep")), "host", "left")
        hit |= F.coalesce("__deep", F.lit(False))
    return split.select(*kept, "host", "path", fits.alias("fit"), F.when(hit, "block").otherwise("allow").alias("own")).select(*kept, "host", "path", F.col("fit.rule").alias("rule"), F.coalesce("fit.verdict", "own").alias("verdict"))
