"""Problem 4: the best representative of each group of duplicate records.

Method: consistent bundles. Fields that depend on one another form bundles, a
bundle is taken from one record whole, and branch and bound picks the bundles
of highest total trust that keep the functional dependencies between bundles.
The record to keep is a bundle of the same search; its trust is the rank that
the project states, and outweighs that of all other bundles together.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import filled, hex_key, label_key
from ..runtime import Workspace, bounded_side, spread_join

#: The fields whose number of filled values counts as completeness, and the tier of unlisted sources.
COMPLETE = ("title", "original_id", "original_url", "license", "publication_date")
LOWEST_TIER = 5
#: Most rows of a tier table, which is broadcast.
TIER_ROWS = 100_000


#: Name of the bundle that is the kept record itself.
KEEPER = "keeper"
#: The keeper's place counts in this unit, above the trust of any choice of other bundles.
KEEPER_UNIT = 1 << 40


@dataclass(frozen=True)
class Bundles:
    """Bundles of dependent fields, and which of them must come from the same source.

    ``same_source`` are pairs of bundles: the surviving record names its source
    (record -> source), an original_id means something only within its source
    (source, original_id -> original_url), and a licence is granted by it
    (source, original_id -> license). An empty bundle binds nothing; the keeper
    is never empty. Names may be any strings.
    """

    fields: tuple[tuple[str, tuple[str, ...]], ...] = (
        ("origin", ("source", "subset", "source_revision")),
        ("identity", ("original_id", "original_url")),
        ("rights", ("license",)),
        ("citation", ("title", "publication_date")),
    )
    same_source: tuple[tuple[str, str], ...] = ((KEEPER, "origin"), ("origin", "identity"), ("identity", "rights"))

    @property
    def names(self) -> tuple[str, ...]:
        return tuple(n for n, _ in self.fields)

    def connected(self) -> list[tuple[int, ...]]:
        """Every set of bundles, by number, that ties of source hold together.

        Bundles that are not empty fall into such sets, each from one source;
        so the sources that lead one of them are all that an optimum can need.
        """
        ties = [(self.names.index(a), self.names.index(b)) for a, b in self.same_source if KEEPER not in (a, b)]
        out = []
        for k in range(1, len(self.fields) + 1):
            for chosen in combinations(range(len(self.fields)), k):
                reached, grown = {chosen[0]}, True
                while grown:
                    more = {y for a, b in ties for x, y in ((a, b), (b, a)) if x in reached and y in chosen} - reached
                    reached, grown = reached | more, bool(more)
                if len(reached) == k:
                    out.append(chosen)
        return out


BUNDLES = Bundles()


def tier_of(tiers: DataFrame, records: DataFrame) -> DataFrame:
    """``records`` with ``__s`` and ``__tier``: subset_tier from 0 to 5, else that of the tier table by source and subset, else 5."""
    table = tiers.select(label_key("source").alias("__s"), label_key("subset").alias("__u"), F.col("tier").alias("__t")).where(F.col("__t").between(0, LOWEST_TIER))
    table = table.groupBy("__s", "__u").agg(F.min("__t").alias("__t"))
    rows = records.withColumns({"__s": label_key("source"), "__u": label_key("subset")})
    own = F.when(F.col("subset_tier").between(0, LOWEST_TIER), F.col("subset_tier"))
    table = bounded_side(table, TIER_ROWS, "a tier table")
    return rows.join(table, ["__s", "__u"], "left").withColumn("__tier", F.coalesce(own, "__t", F.lit(LOWEST_TIER)).cast("int")).drop("__t", "__u")


def _completeness() -> Column:
    return sum((filled(c).cast("int") for c in COMPLETE), F.lit(0))


def _age(stamp: str) -> Column:
    """Larger is older; NULL is oldest."""
    return F.coalesce(-F.unix_micros(F.col(stamp).cast("timestamp")), F.lit(2**62).cast("long"))


#: Columns that are read; whatever else a table holds, under any name, is left aside first.
READ = tuple(dict.fromkeys(("record_id", "content_sha256", "source", "subset", "subset_tier", "loaded_at", "updated_at", *COMPLETE)))


def ranked_records(records: DataFrame, tiers: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """The current row of each record with what its rank needs: ``record_id, content_sha256, tier, complete, age``, then the folded source ``__s`` and the values of ``carry`` as ``__f0, __f1, ...``.

    The current row has the latest loaded_at (NULL is oldest; ties: the latest
    updated_at, then the larger content hash, then the better rank).
    """
    told = [F.coalesce("__s", F.lit("")).alias("s"), *[F.col(c).cast("string").alias(f"f{i}") for i, c in enumerate(carry)]] if carry else []
    rows = tier_of(tiers, records.select(*dict.fromkeys([*READ, *carry]))).select(
        hex_key("record_id").alias("record_id"),
        F.struct(
            "loaded_at", "updated_at", F.nullif(hex_key("content_sha256"), F.lit("")).alias("content_sha256"), (-F.col("__tier")).alias("t"), _completeness().alias("complete"), *told
        ).alias("r"),
    )
    current = rows.where(F.col("record_id") != "").groupBy("record_id").agg(F.max("r").alias("r"))
    more = [F.col("r.s").alias("__s"), *[F.col(f"r.f{i}").alias(f"__f{i}") for i in range(len(carry))], F.col("r.updated_at").alias("__updated")] if carry else []
    return current.select("record_id", "r.content_sha256", (-F.col("r.t")).alias("tier"), "r.complete", _age("r.updated_at").alias("age"), *more)


def representatives(ranked: DataFrame) -> DataFrame:
    """``(content_sha256, representative_record_id, copies)`` for every content: lowest tier, most complete, latest, smallest id."""
    best = F.min(F.struct("tier", (-F.col("complete")).alias("less"), "age", "record_id"))
    return (
        ranked.where(F.col("content_sha256").isNotNull())
        .groupBy("content_sha256")
        .agg(best.alias("b"), F.count(F.lit(1)).alias("copies"))
        .select("content_sha256", F.col("b.record_id").alias("representative_record_id"), "copies")
    )


def branch_and_bound(choices: list[list[tuple[int, str, tuple]]], same: list[tuple[int, int]]) -> tuple[int, list[int]]:
    """The choice of one candidate a bundle with the highest total score.

    ``choices[i]`` are candidates ``(score, source, values)`` of bundle i, best
    first, the empty one (score 0, source '') among them; ``same`` are pairs of
    bundles whose sources must agree unless one is empty. Of equal totals the
    earliest candidates win.
    """
    n = len(choices)
    rest = [0] * (n + 1)
    for i in range(n - 1, -1, -1):
        rest[i] = rest[i + 1] + choices[i][0][0]
    bound_to = [[x if y == i else y for x, y in same if i in (x, y) and min(x, y) < i] for i in range(n)]
    best, best_pick = -1, []
    pick: list[int] = []

    def go(i: int, score: int) -> None:
        nonlocal best, best_pick
        if i == n:
            if score > best:
                best, best_pick = score, pick[:]
            return
        for k, (s, source, _) in enumerate(choices[i]):
            if score + s + rest[i + 1] <= best:
                return  # candidates are sorted: no later one can do better
            if source and any((other := choices[j][pick[j]][1]) and other != source for j in bound_to[i]):
                continue
            pick.append(k)
            go(i + 1, score + s)
            pick.pop()

    go(0, 0)
    return best, best_pick


def survivors(records: DataFrame, tiers: DataFrame, bundles: Bundles = BUNDLES) -> DataFrame:
    """One surviving record for each content that two or more current records share.

    Result: ``content_sha256, representative_record_id, copies``, every field
    of the bundles with its best value, ``bundle_records`` (the record each
    bundle comes from, in the order of the bundles) and ``trust``.

    The search chooses the keeper (lowest tier, most complete, latest, smallest
    id) and a candidate for each bundle. A bundle of a record scores 0 when
    none of its fields is filled, else by tier, then filled fields, then
    recency. Of each content and source only the best candidate of a bundle
    can matter, and of the sources only those that lead the keepers or a
    connected set of bundles: an optimum is made of such sets, each from one
    source, and could give each to its leader. So the search sees a handful of
    candidates however many copies there are, loses no optimum, and everything
    before it is partially aggregated where the rows lie.

    * NULL content_sha256: belongs to no group. NULL, blank or ``none`` fields are not filled and come out as NULL.
    * Repeated rows: the current row, see :func:`ranked_records`. Equal scores: within a source the smallest record_id, between sources the smaller name.
    * Empty records: empty result. Empty tiers: all sources have the lowest tier.
    """
    ws = Workspace(records.sparkSession)
    every = tuple(f for _, fields in bundles.fields for f in fields)
    ranked = ws.write(ranked_records(records, tiers, every).where(F.col("content_sha256").isNotNull()))
    shared = ranked.groupBy("content_sha256").agg(F.count(F.lit(1)).alias("copies")).where(F.col("copies") > 1)
    rows = spread_join(ranked, shared, ["content_sha256"], "record_id", size="copies")
    recency = F.greatest(F.lit(0), F.least(F.lit(999_999), F.coalesce(F.datediff(F.col("__updated"), F.lit("1970-01-01")), F.lit(0))))
    at, offers = 0, []
    for k, (_, fields) in enumerate(bundles.fields):
        columns = [f"__f{at + i}" for i in range(len(fields))]
        at += len(fields)
        full = sum((filled(c).cast("int") for c in columns), F.lit(0))
        score = F.when(full == 0, F.lit(0)).otherwise((LOWEST_TIER + 1 - F.col("tier")) * 10_000_000 + full * 1_000_000 + recency).cast("long")
        offers.append(F.struct((-score).alias("less"), F.col("record_id").alias("id"), *[F.when(filled(c), F.col(c)).alias(f"v{i}") for i, c in enumerate(columns)]).alias(f"__b{k}"))
    keeper = F.struct("tier", (-F.col("complete")).alias("less"), "age", F.col("record_id").alias("id")).alias("__k")
    made = rows.select("content_sha256", "copies", "__s", keeper, *offers)
    names = ["__k", *[f"__b{k}" for k in range(len(offers))]]
    by_source = made.groupBy("content_sha256", "copies", "__s").agg(*[F.min(n).alias(n) for n in names])
    whole = F.struct("__s", *names)
    leads = [F.min(F.struct(F.col("__k").alias("o"), whole.alias("w")))]
    leads += [F.min(F.struct(sum((F.col(f"__b{k}.less") for k in part), F.lit(0)).alias("o"), whole.alias("w"))) for part in bundles.connected()]
    led = by_source.groupBy("content_sha256", "copies").agg(*[x.alias(f"__l{i}") for i, x in enumerate(leads)])
    lists = led.select("content_sha256", "copies", F.array(*[F.col(f"__l{i}.w") for i in range(len(leads))]).alias("led"))
    schema = "content_sha256 string, representative_record_id string, copies long, " + ", ".join(f"`{f}` string" for f in every) + ", bundle_records array<string>, trust long"
    return lists.mapInPandas(_merger(bundles), schema)


def _merger(bundles: Bundles):
    names = (KEEPER, *bundles.names)
    same = [(names.index(a), names.index(b)) for a, b in bundles.same_source]
    every = [f for _, fs in bundles.fields for f in fs]

    def keepers(led: list) -> list[tuple[int, str, dict]]:
        best = {x["__s"]: x["__k"] for x in led}
        ranked = sorted(best.items(), key=lambda e: (e[1]["tier"], e[1]["less"], e[1]["age"], e[1]["id"]))
        # a record without a source is bound to no source; its place in the list keeps it apart
        return [((len(ranked) - i) * KEEPER_UNIT, s or f"\0{i}", k) for i, (s, k) in enumerate(ranked)]

    def merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for content, copies, led in zip(batch["content_sha256"], batch["copies"], batch["led"], strict=True):
                choices = [keepers(led)]
                for k, _ in enumerate(bundles.fields):
                    offered = {(-x[f"__b{k}"]["less"], x["__s"], x[f"__b{k}"]["id"]): x[f"__b{k}"] for x in led if x[f"__b{k}"]["less"] < 0}
                    best_first = sorted(offered, key=lambda o: (-o[0], o[1], o[2]))
                    choices.append([(o[0], o[1], offered[o]) for o in best_first] + [(0, "", None)])
                total, pick = branch_and_bound(choices, same)
                chosen = [choices[i][p][2] for i, p in enumerate(pick)]
                values = []
                for (_, fields), c in zip(bundles.fields, chosen[1:], strict=True):
                    values += [c[f"v{i}"] if c is not None else None for i in range(len(fields))]
                taken = [c["id"] if c is not None else None for c in chosen[1:]]
                out.append((content, chosen[0]["id"], copies, *values, taken, total % KEEPER_UNIT))
            yield pd.DataFrame(out, columns=["content_sha256", "representative_record_id", "copies", *every, "bundle_records", "trust"])

    return merge


def dispositions(records: DataFrame, tiers: DataFrame) -> DataFrame:
    """``(record_id, content_sha256, representative_record_id, disposition)`` for every record.

    ``retained`` is the representative, or a record without copies or without
    content hash; every other record is ``dropped``.
    """
    ranked = Workspace(records.sparkSession).write(ranked_records(records, tiers))
    rows = spread_join(ranked, representatives(ranked), ["content_sha256"], "record_id", "left", "copies")
    rep = F.coalesce("representative_record_id", "record_id")
    return rows.select(
        "record_id", "content_sha256", rep.alias("representative_record_id"), F.when(rep == F.col("record_id"), "retained").otherwise("dropped").alias("disposition")
    )


def _tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return spark.read.parquet(f"{sf_dir}/records.parquet"), spark.read.parquet(f"{sf_dir}/source_tier.parquet")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The record to keep for every content shared by two or more records."""
    return survivors(*_tables(spark, sf_dir)).select("content_sha256", F.col("representative_record_id").alias("record_id"))


def p4_survivors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The merged record of every group of copies; ``bundle_records`` in one string, ``-`` for an empty bundle."""
    told = F.concat_ws(";", F.transform("bundle_records", lambda r: F.coalesce(r, F.lit("-"))))
    return survivors(*_tables(spark, sf_dir)).withColumn("bundle_records", told)


def p4_dispositions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The disposition of every record."""
    return dispositions(*_tables(spark, sf_dir))


QUERIES = {"p4_found": p4_found, "p4_survivors": p4_survivors, "p4_dispositions": p4_dispositions}

_FILLED = " + ".join(f"CAST(coalesce(lower(trim({c}, ' ' || chr(9) || chr(10) || chr(13) || chr(160))), '') NOT IN ('', 'none') AS INT)" for c in COMPLETE)
_RANKED = f"""
WITH tier AS (
    SELECT lower(regexp_replace(nfc_normalize(source), '[^\\p{{L}}\\p{{N}}]+', '', 'g')) AS s,
           lower(regexp_replace(nfc_normalize(subset), '[^\\p{{L}}\\p{{N}}]+', '', 'g')) AS u, min(tier) AS t
    FROM source_tier GROUP BY 1, 2),
rec AS (
    SELECT lower(regexp_replace(record_id, '[^0-9A-Za-z]+', '', 'g')) AS id,
           lower(regexp_replace(content_sha256, '[^0-9A-Za-z]+', '', 'g')) AS content, loaded_at, updated_at,
           coalesce(CASE WHEN subset_tier BETWEEN 0 AND 5 THEN subset_tier END, t, 5) AS tier, {_FILLED} AS full_fields
    FROM records LEFT JOIN tier
      ON s = lower(regexp_replace(nfc_normalize(source), '[^\\p{{L}}\\p{{N}}]+', '', 'g'))
     AND u = lower(regexp_replace(nfc_normalize(subset), '[^\\p{{L}}\\p{{N}}]+', '', 'g'))),
cur AS (SELECT * FROM rec QUALIFY row_number() OVER (PARTITION BY id ORDER BY loaded_at DESC NULLS LAST, updated_at DESC NULLS LAST) = 1),
ranked AS (
    SELECT *, count(*) OVER (PARTITION BY content) AS copies,
           first_value(id) OVER (PARTITION BY content ORDER BY tier, full_fields DESC, updated_at DESC NULLS LAST, id) AS rep
    FROM cur)
"""


def _best(bundle: str, fields: tuple[str, ...]) -> str:
    """Of each content and source the best record of a bundle, and the empty choice; ``n`` is its place among the content's choices."""
    full = " + ".join(f"CAST(coalesce(lower(trim({c}, ' ' || chr(9) || chr(10) || chr(13) || chr(160))), '') NOT IN ('', 'none') AS INT)" for c in fields)
    values = ", ".join(f"CASE WHEN coalesce(lower(trim({c}, ' ' || chr(9) || chr(10) || chr(13) || chr(160))), '') NOT IN ('', 'none') THEN {c} END AS {c}" for c in fields)
    none = ", ".join(f"NULL AS {c}" for c in fields)
    return f"""
{bundle}_all AS (SELECT content, s, id, ({full}) AS full_n, (6 - tier) * 10000000 + ({full}) * 1000000 + greatest(0, least(999999, coalesce(date_diff('day', DATE '1970-01-01', updated_at::DATE), 0))) AS score, {values} FROM member),
{bundle}_top AS (SELECT * FROM {bundle}_all WHERE full_n > 0 QUALIFY row_number() OVER (PARTITION BY content, s ORDER BY score DESC, id) = 1),
{bundle} AS (SELECT content, s, id, score, {", ".join(fields)}, row_number() OVER (PARTITION BY content ORDER BY score DESC, s, id) AS n FROM {bundle}_top
    UNION ALL SELECT DISTINCT content, NULL AS s, NULL AS id, 0 AS score, {none}, 1000000 AS n FROM member)"""


_EVERY = tuple(f for _, fields in BUNDLES.fields for f in fields)
_WIDE = _RANKED.replace("AS content, loaded_at", "AS content, coalesce(lower(regexp_replace(nfc_normalize(records.source), '[^\\p{L}\\p{N}]+', '', 'g')), '') AS src, records.* EXCLUDE (record_id, content_sha256, loaded_at, updated_at, subset_tier), loaded_at")
SQL = {
    "p4_found": _RANKED + "SELECT DISTINCT content AS content_sha256, rep AS record_id FROM ranked WHERE copies > 1 AND content IS NOT NULL",
    "p4_dispositions": _RANKED
    + """SELECT id AS record_id, content AS content_sha256,
        CASE WHEN content IS NULL THEN id ELSE rep END AS representative_record_id,
        CASE WHEN content IS NULL OR rep = id THEN 'retained' ELSE 'dropped' END AS disposition FROM ranked""",
    # all choices of sources, without the search and without its leaders
    "p4_survivors": f"""{_WIDE}, member AS (SELECT content, id, src AS s, tier, updated_at, copies, rep, {", ".join(_EVERY)} FROM ranked WHERE copies > 1 AND content IS NOT NULL),
{",".join(_best(n, f) for n, f in BUNDLES.fields)},
kept AS (SELECT content, s, id, copies FROM member WHERE id = rep),
chosen AS (
    SELECT kept.content AS content_sha256, kept.id AS representative_record_id, copies, {", ".join(_EVERY)},
           coalesce(origin.id, '-') || ';' || coalesce(identity.id, '-') || ';' || coalesce(rights.id, '-') || ';' || coalesce(citation.id, '-') AS bundle_records,
           (origin.score + identity.score + rights.score + citation.score)::BIGINT AS trust
    FROM kept JOIN origin ON origin.content = kept.content JOIN identity ON identity.content = kept.content JOIN rights ON rights.content = kept.content JOIN citation ON citation.content = kept.content AND citation.n IN (1, 1000000)
    WHERE (origin.s IS NULL OR origin.s = kept.s) AND (origin.s IS NULL OR identity.s IS NULL OR origin.s = identity.s) AND (identity.s IS NULL OR rights.s IS NULL OR identity.s = rights.s)
    QUALIFY row_number() OVER (PARTITION BY kept.content ORDER BY origin.score + identity.score + rights.score + citation.score DESC, origin.n, identity.n, rights.n, citation.n) = 1)
SELECT * FROM chosen""",
}
