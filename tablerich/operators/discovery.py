"""Entity discovery: match conditions, limits, exclusions, output fields and ranked entity search."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window, functions as F

from tablerich.operators.enrich import enrich
from tablerich.operators.naming import output_columns
from tablerich.operators.resolvers import RESULT, Resolver
from tablerich.operators.search import Corpus, host, rank_documents

# Fixed values.
GENERATORS = ("base", "core", "pro")
ENTITY_TYPES = ("companies", "people")
INTERNAL_FIELDS = ("candidate_id", "match_status", "basis")
MIN_LIMIT, MAX_LIMIT, DEFAULT_LIMIT = 5, 1000, 10

OUTPUT_TYPE = "map<string,struct<type:string,value:string,is_matched:boolean>>"


@dataclass(frozen=True)
class Condition:
    """A described match condition and the predicate that decides it."""

    name: str
    description: str
    predicate: Column
    value: Column | None = None


@dataclass(frozen=True)
class Enrichment:
    """Extra fields for matches, each with a resolver of its own."""

    outputs: Sequence[str]
    inputs: Mapping[str, str]
    resolver: Resolver


@dataclass(frozen=True)
class Discovery:
    """What to look for in a table of entities."""

    objective: str
    entity_type: str
    entities: DataFrame
    id: str
    conditions: Sequence[Condition]
    score: Column
    generator: str = "core"
    match_limit: int = DEFAULT_LIMIT
    enrichments: Sequence[Enrichment] = field(default_factory=tuple)

    def __post_init__(self):
        if self.generator not in GENERATORS:
            raise ValueError(f"generator must be one of {GENERATORS}")
        check_limit(self.match_limit)

    @property
    def _tests(self) -> list[Column]:
        return [F.coalesce(c.predicate, F.lit(False)) for c in self.conditions]

    def preview(self) -> DataFrame:
        """One row per condition with the entities that meet it; nothing is matched yet."""
        counted = self.entities.agg(*[F.count_if(t).alias(f"c{i}") for i, t in enumerate(self._tests)])
        rows = F.array(
            *[
                F.struct(
                    F.lit(self.entity_type).alias("entity_type"),
                    F.lit(c.name).alias("condition"),
                    F.lit(c.description).alias("description"),
                    F.col(f"c{i}").alias("entities"),
                )
                for i, c in enumerate(self.conditions)
            ]
        )
        return counted.select(F.inline(rows))

    def pool(self) -> DataFrame:
        """Entities taken as candidates.

        ``base`` requires the first condition, ``core`` any condition, ``pro`` takes all. Every tier
        holds all entities that meet all conditions, so the tier never changes which ones match.
        """
        if self.generator == "base":
            return self.entities.filter(self._tests[0])
        if self.generator == "core":
            wide = F.lit(False)
            for t in self._tests:
                wide = wide | t
            return self.entities.filter(wide)
        return self.entities

    def candidates(self, exclude: DataFrame | None = None, name: str | None = None, url: str | None = None) -> DataFrame:
        """The pool with ``output``, ``match_status``, ``conditions_met`` and ``score``."""
        pool = self.pool()
        if exclude is not None:
            pool = exclude_entities(pool, exclude, name, url)
        met = F.lit(0)
        for t in self._tests:
            met = met + t.cast("int")
        pairs = []
        for c, t in zip(self.conditions, self._tests):
            value = t if c.value is None else c.value
            pairs += [
                F.lit(c.name),
                F.struct(
                    F.lit("match_condition").alias("type"),
                    value.cast("string").alias("value"),
                    t.alias("is_matched"),
                ),
            ]
        return pool.withColumns(
            {
                "output": F.create_map(*pairs).cast(OUTPUT_TYPE),
                "conditions_met": met,
                "score": self.score,
                "match_status": F.when(met == len(self.conditions), "matched").otherwise("unmatched"),
            }
        )

    def run(self, **exclusion) -> DataFrame:
        """The best matches, at most ``match_limit``; a fixed total order makes the result stable."""
        return self.ranked(matched(self.candidates(**exclusion))).limit(self.match_limit)

    def table(self, *, enrich: bool = True, fields: Sequence[str] | None = None, **exclusion) -> DataFrame:
        """The best matches as a text table, with the enrichments unless ``enrich`` is off."""
        found = self.run(**exclusion)
        if enrich:
            for e in self.enrichments:
                found = enrich_matched(found, e.inputs, e.outputs, e.resolver)
        if fields is None:
            # Known from the request: reading them off the result would run the discovery twice.
            added = [o.name for e in self.enrichments for o in output_columns(e.outputs)] if enrich else []
            fields = list(dict.fromkeys([*(c.name for c in self.conditions), *added]))
        return flatten(found, self.id, fields)

    def ranked(self, candidates: DataFrame) -> DataFrame:
        return candidates.orderBy(*self._order)

    @property
    def _order(self) -> list[Column]:
        return [F.desc("conditions_met"), F.desc("score"), F.asc(self.id)]

    def extend(self, additional: int, **exclusion) -> DataFrame:
        """Only the matches that raising the limit by ``additional`` brings in."""
        if not 1 <= additional <= MAX_LIMIT:
            raise ValueError(f"additional must be from 1 to {MAX_LIMIT}")
        top = self.ranked(matched(self.candidates(**exclusion))).limit(self.match_limit + additional)
        # At most 2 * MAX_LIMIT rows are left here.
        numbered = top.withColumn("rank", F.row_number().over(Window.orderBy(*self._order)))
        return numbered.filter(F.col("rank") > self.match_limit)


def check_limit(limit: int) -> int:
    if not MIN_LIMIT <= limit <= MAX_LIMIT:
        raise ValueError(f"match_limit must be from {MIN_LIMIT} to {MAX_LIMIT}")
    return limit


def normalised(name: Column) -> Column:
    return F.regexp_replace(F.lower(name), r"[^\p{L}\p{N}]", "")


def exclude_entities(entities: DataFrame, exclude: DataFrame, name: str | None, url: str | None) -> DataFrame:
    """Drop entities whose normalised name or URL host is in ``exclude (name, url)``.

    One anti join for each, because a single join on "either" has no equality to partition by.
    """
    left = entities
    if name:
        names = exclude.select(normalised(F.col("name")).alias("_n")).filter("_n != ''").distinct().hint("rebalance")
        left = left.join(names, normalised(F.col(name)) == F.col("_n"), "left_anti")
    if url:
        hosts = exclude.select(host(F.col("url")).alias("_h")).filter("_h is not null").distinct().hint("rebalance")
        left = left.join(hosts, host(F.col(url)) == F.col("_h"), "left_anti")
    return left


def matched(candidates: DataFrame) -> DataFrame:
    return candidates.filter(F.col("match_status") == "matched")


def metrics(candidates: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return candidates.groupBy(*by).agg(
        F.count(F.lit(1)).alias("generated"), F.count_if(F.col("match_status") == "matched").alias("matched")
    )


def output_values(output: Column) -> Column:
    """``map<string,string>`` of the bare values."""
    return F.transform_values(output, lambda _, v: v["value"])


def output_fields(candidates: DataFrame, order: str) -> list[str]:
    """Field names in first-seen order. Names are reduced on the cluster; only the names come back."""
    seen = candidates.select(order, F.posexplode(F.map_keys("output")).alias("_pos", "_field"))
    first = seen.groupBy("_field").agg(F.min(F.struct(order, "_pos")).alias("_at"))
    # The names become the columns of the result, so the plan needs them.
    return [r["_field"] for r in first.orderBy("_at").collect()]


def flatten(candidates: DataFrame, order: str, fields: Sequence[str] | None = None) -> DataFrame:
    """Matched candidates as a text table: own columns, then one column per output field.

    Internal fields are dropped, nested values become JSON text, missing ones null.
    """
    rows = matched(candidates)
    fields = output_fields(rows, order) if fields is None else fields
    columns = {}
    for f in rows.schema:
        if f.name in (*INTERNAL_FIELDS, "output"):
            continue
        nested = f.dataType.typeName() in ("struct", "array", "map")
        columns[f.name] = F.to_json(f.name) if nested else F.col(f"`{f.name}`").cast("string")
    values = output_values(F.col("output"))
    for n in fields:
        # An output field wins over a column of its name.
        own = columns.get(n, F.lit(None).cast("string"))
        columns[n] = F.when(F.map_contains_key(F.col("output"), n), values[n]).otherwise(own)
    return rows.select(*[c.alias(n) for n, c in columns.items()])


def flatten_union(parts: Sequence[DataFrame], order: str) -> DataFrame:
    """Flatten candidate tables with different columns into one."""
    flat = [flatten(p, order) for p in parts]
    out = flat[0]
    for part in flat[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def as_json(candidates: DataFrame, by: str, order: Sequence[Column], limit: int = DEFAULT_LIMIT) -> DataFrame:
    """``(by, candidates)``: a JSON array with the best ``limit`` matches of each objective, empty without any."""
    is_match = F.coalesce(F.col("match_status") == "matched", F.lit(False))
    best = Window.partitionBy(by).orderBy(is_match.desc(), *order)
    output = F.coalesce("output", F.create_map().cast(OUTPUT_TYPE))
    top = candidates.withColumn("output", output).withColumn("_rank", F.row_number().over(best)).filter(
        F.col("_rank") <= check_limit(limit)
    )
    own = [c for c in candidates.columns if c not in (*INTERNAL_FIELDS, by, "output")]
    base = F.map_filter(
        F.create_map(*[x for c in own for x in (F.lit(c), F.col(c).cast("string"))]), lambda _, v: v.isNotNull()
    )
    base = F.map_filter(base, lambda k, _: ~F.map_contains_key(F.col("output"), k))
    cleaned = top.select(by, "_rank", is_match.alias("_m"), F.map_concat(base, output_values(F.col("output"))).alias("_c"))
    # At most ``limit`` rows per objective are gathered.
    item = F.when(F.col("_m"), F.struct("_rank", F.to_json("_c").alias("j")))
    gathered = cleaned.groupBy(by).agg(F.collect_list(item).alias("_l"))
    items = F.transform(F.array_sort("_l"), lambda x: x["j"])
    return gathered.select(by, F.concat(F.lit("["), F.array_join(items, ","), F.lit("]")).alias("candidates"))


def from_json_rows(df: DataFrame, by: str, column: str, fields: Sequence[str]) -> DataFrame:
    """Unnest the JSON arrays again: one row per candidate."""
    one = F.explode(F.from_json(column, "array<map<string,string>>")).alias("_c")
    return df.select(by, one).select(by, *[F.col("_c")[f].alias(f) for f in fields])


def enrich_matched(
    candidates: DataFrame, inputs: Mapping[str, str], outputs: Sequence[str], resolver: Resolver
) -> DataFrame:
    """Add answers to ``output`` of matched rows only; the others pass unchanged."""
    done = enrich(matched(candidates), inputs, outputs, resolver)
    names = [o.name for o in done.outputs]
    texts = dict(zip(names, done.texts()))
    pairs = [
        x
        for n in names
        for x in (
            F.lit(n),
            F.struct(F.lit("enrichment").alias("type"), texts[n].alias("value"),
                     F.lit(None).cast("boolean").alias("is_matched")),
        )
    ]
    extra = F.map_filter(F.create_map(*pairs).cast(OUTPUT_TYPE), lambda _, v: v["value"].isNotNull())
    old = F.map_filter("output", lambda k, _: ~k.isin(*names))
    kept = [F.col(c) for c in candidates.columns if c != "output"]
    merged = done.rows.select(*kept, F.map_concat(old, extra).alias("output"))
    rest = candidates.filter(F.col("match_status") != "matched")
    return merged.select(*candidates.columns).unionByName(rest)


def coverage(candidates: DataFrame, expected: Sequence[str]) -> DataFrame:
    """How many matches hold all expected fields: ``(total, enriched, done)``."""
    wanted = F.array(*[F.lit(e) for e in expected])
    full = F.size(F.array_except(wanted, F.map_keys("output"))) == 0
    return matched(candidates).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(full).alias("enriched"),
        F.coalesce(F.bool_and(full), F.lit(True)).alias("done"),
    )


def entity_search(
    entities: Mapping[str, Corpus], entity_type: str, query: str, limit: int = DEFAULT_LIMIT
) -> DataFrame:
    """Ranked entities of one type."""
    if entity_type not in ENTITY_TYPES:
        raise ValueError(f"entity_type must be one of {ENTITY_TYPES}")
    return rank_documents(entities[entity_type], [query], limit=check_limit(limit)).drop("query_no")
