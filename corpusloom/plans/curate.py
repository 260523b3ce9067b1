"""Stage 1: from source rows to kept records, tombstones and splits."""

from __future__ import annotations

from dataclasses import asdict, dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import names
from corpusloom.functions.pycode import with_features
from corpusloom.logs import logger
from corpusloom.operators import exact, retention, similarity
from corpusloom.operators.components import connected_components
from corpusloom.operators.skew import attach
from corpusloom.operators.splits import family_split
from corpusloom.sources import files, sinks
from corpusloom.workspace import Workspace

TOMBSTONE = "id string, canonical string, reason string, name string, canonical_name string, jaccard double, family_tag string, struct_jaccard double"


@dataclass
class Curation:
    includes: list[str] = field(default_factory=list)
    prefer_order: list[str] | None = None  # none given: the includes
    min_per_prefix: int = 1
    keep_per_family: int = 5
    shingle: int = 10
    lexical: float = 0.90
    lexical_fractal: float = 0.97
    structural: float = 0.90
    topup_prefixes: list[str] | None = None  # none given: the includes that begin with FractalNet
    topup_per_prefix: int = 10
    topup_lexical: float = 0.85
    topup_structural: float = 0.60
    retrieval: str = "exact"  # or "lsh"
    seed: int = 42

    @property
    def preferred(self) -> list[str]:
        return self.prefer_order or self.includes

    @property
    def topups(self) -> list[str]:
        return self.topup_prefixes or [p for p in self.includes if names.normal_text(p).startswith("fractalnet")]


def curate(rows: DataFrame, config: Curation = Curation(), ws: Workspace | None = None) -> dict[str, DataFrame]:
    """``rows`` (those of the included prefixes), ``records``, ``kept`` (with reason), ``tombstones`` and ``splits`` for rows
    ``(row_idx, name, code, accuracy)``.

    Code is read for features once for each distinct text, and else joined only to what is kept. It isn't written: ``rows`` are read
    anew for it, so where their values may differ from one reading to the next they are written as they are.
    """
    ws = ws or Workspace(rows.sparkSession)
    if not rows._jdf.queryExecution().analyzed().deterministic():
        rows = ws.table(rows, "rows")
    chosen = rows.filter(names.has_prefix(F.col("name"), config.includes)) if config.includes else rows
    logger.info("exact duplicates")
    full = exact.make_records(chosen)
    records = ws.table(full.drop("code"), "records")
    canonical = exact.exact_groups(records, config.preferred, ws)
    groups = ws.table(canonical, "exact")
    kept = ws.table(exact.kept(groups).join(records, "id"), "kept")
    gone = [ws.table(exact.tombstones(groups), "copies")]
    ws.drop(canonical, groups)

    logger.info("lexical near-duplicates")
    # one row for each distinct text, with all that is known of its record
    seen = features = ws.table(with_features(kept.join(full.select("id", "code"), "id"), "id", "code", config.shingle, kept.columns[1:]), "features")
    ws.drop(kept)
    kept = seen.drop("n_tokens", "shingles", "bag", "fp_hash")
    stricter = F.when(F.col("family").startswith("fractal"), config.lexical_fractal).otherwise(config.lexical)
    retrieve = similarity.lsh_classes if config.retrieval == "lsh" else similarity.similar_classes
    sets = seen.select("id", F.col("family_tag").alias("family"), F.col("shingles").alias("items"))
    members, links = retrieve(sets, min(config.lexical, config.lexical_fractal), stricter, ws)
    components = ws.table(connected_components(similarity.chained(members, links), "a", "b", ws), "components")
    marked = ws.table(retention.keep_best(kept, components, config.keep_per_family, config.includes, ws), "marked")
    near = ws.table(marked.filter("reason is not null").select("id", "canonical", "reason"), "near")
    ws.drop(members, links, components, marked)
    gone.append(_compared(near, seen.select("id", "name", "family_tag", F.col("shingles").alias("items")), ws))
    standing = ws.table(seen.drop("shingles", "code_hash").join(near.select("id"), "id", "left_anti"), "standing")
    ws.drop(near)

    logger.info("structural duplicates")
    best = standing.withColumn("key", exact.quality_key()).groupBy("fp_hash").agg(F.min("key").alias("key"), F.count("*").alias("n"))
    best = ws.table(best.select("fp_hash", F.col("key.best_id").alias("canonical"), F.col("key.by_name").alias("canonical_name"), "n").filter("n > 1"), "prints")
    same = attach(standing.select("id", "name", "fp_hash"), best, ["fp_hash"], "n").filter("id <> canonical")
    same = ws.table(same.select("id", "canonical", F.lit("structural_duplicate_exact").alias("reason"), "name", "canonical_name"), "same")
    gone.append(same)
    single = ws.table(standing.join(same.select("id"), "id", "left_anti"), "single")
    ws.drop(standing, best)
    bags = single.select("id", F.lit("all").alias("family"), F.col("bag").alias("items")).filter("size(items) > 0")
    edges = ws.table(similarity.all_pairs(*similarity.similar_classes(bags, config.structural, ws=ws)), "structural")
    removed = ws.table(retention.structural_greedy(_ranked(single.join(edges.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "id", "left_semi"), ws), edges, ws), "greedy")
    named = single.select("id", "name")
    near = removed.join(named, "id").join(named.toDF("canonical", "canonical_name"), "canonical")
    gone.append(near.select("id", "canonical", F.lit("structural_duplicate_near").alias("reason"), "name", "canonical_name", F.round("similarity", 3).alias("struct_jaccard")))
    empty = rows.sparkSession.createDataFrame([], TOMBSTONE)
    tombstones = ws.table(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), gone, empty), "tombstones")

    logger.info("prefixes and diversity")
    final = ws.table(single.join(removed.select("id"), "id", "left_anti").select("id", "reason"), "final")
    ws.drop(*gone, same, single, edges, removed)
    final = _rescued(final, tombstones, records, features, config, ws)
    out = ws.table(final.join(full, "id"), "out")
    splits = family_split(out.select("id", "code_hash").join(features.select("code_hash", "fp_hash"), "code_hash"), "id", "fp_hash")
    return {"rows": chosen, "records": full, "kept": out, "tombstones": tombstones, "splits": splits}


def _compared(near: DataFrame, sets: DataFrame, ws: Workspace) -> DataFrame:
    """Tombstones for ``near`` (id, canonical, reason) with names, family and the similarity to the canonical record."""
    counts = near.groupBy("canonical").agg(F.count("*").alias("n"))
    kept = ws.table(counts.join(sets.select(F.col("id").alias("canonical"), F.col("name").alias("canonical_name"), F.col("items").alias("right")), "canonical"), "canonical")
    removed = ws.table(near.join(sets, "id"), "removed")
    both = attach(removed, kept, ["canonical"], "n")
    both = both.select("id", "canonical", "reason", "name", "canonical_name", F.round(similarity.jaccard(F.col("items"), F.col("right")), 3).alias("jaccard"), "family_tag")
    out = ws.table(both, "lexical")
    ws.drop(kept, removed)
    return out


def _ranked(rows: DataFrame, ws: Workspace) -> DataFrame:
    """``(id, ord, quality)`` where quality numbers the distinct keys in ascending order: equal quality has an equal rank."""
    key = F.struct(F.col("accuracy").isNull().alias("u"), (-F.col("accuracy")).alias("a"), (-F.col("size")).alias("l"), F.col("name").alias("n"))
    keyed = ws.table(rows.select("id", "ord", F.to_json(F.struct(key.alias("q"))).alias("k"), key.alias("q")), "keyed")
    order = ws.table(keyed.groupBy("k").agg(F.min("q").alias("q"), F.count("*").alias("n")).orderBy("q", "k").select("k", "n", F.monotonically_increasing_id().alias("quality")), "ranks")
    return attach(keyed, order, ["k"], "n").select("id", "ord", "quality")


def _rescued(final: DataFrame, tombstones: DataFrame, records: DataFrame, features: DataFrame, config: Curation, ws: Workspace) -> DataFrame:
    """Adds what each prefix still lacks, and then diverse records of the top-up prefixes.

    Of one code only the best record can be accepted, for its copies are then kept already.
    """
    jobs = [("rescued_by_prefix", p) for p in config.includes] + [("diversity_topup", p) for p in config.topups]
    have = {r.p: r.n for r in final.join(records, "id").select(names.matched_prefix(F.col("name"), config.includes).alias("p")).groupBy("p").agg(F.count("*").alias("n")).collect()} if config.includes else {}
    strict = F.when(F.col("family_tag").startswith("fractal"), config.lexical_fractal).otherwise(config.lexical) - 1e-9
    for reason, prefix in jobs:
        rescue = reason == "rescued_by_prefix"
        need = config.min_per_prefix - have.get(prefix, 0) if rescue else config.topup_per_prefix
        if need <= 0:
            continue
        limits = (strict, F.lit(2.0)) if rescue else (F.lit(config.topup_lexical + 1e-9), F.lit(config.topup_structural + 1e-9))
        same = records.filter(names.has_prefix(F.col("name"), [prefix])).withColumns({"lexical": limits[0], "structural": limits[1]})
        known = final.select("id").join(records.select("id", "code_hash"), "id").select("code_hash").distinct()
        best = same.join(tombstones.select("id").distinct(), "id", "left_semi").withColumn("key", exact.quality_key()).groupBy("code_hash").agg(F.min(F.struct("key", "id", "lexical", "structural")).alias("m"))
        pool = best.join(known, "code_hash", "left_anti").select("code_hash", "m.*")
        standing = final.select("id").join(same, "id").select("code_hash", "lexical", "structural")
        with_sets = lambda d: ws.table(d.join(features.select("code_hash", "shingles", "bag", "fp_hash"), "code_hash"), "compared")
        standing, pool = compared = with_sets(standing), with_sets(pool)
        if not rescue and config.topup_structural < 1:
            # equal in structure to one that stands; where the limit is below 1, that rules it out
            pool = ws.table(pool.join(standing.filter("size(bag) > 0").select("fp_hash").distinct(), "fp_hash", "left_anti"), "pool")
        accepted = retention.accept_diverse(pool, standing, need)
        ws.drop(*compared, pool)
        logger.info("%s: %d of %d for prefix %s", reason, len(accepted), need, prefix)
        if accepted:
            more = rows_of(final.sparkSession, accepted, reason)
            final = ws.table(final.unionByName(more), "kept")
    return final


def rows_of(spark, ids: list[str], reason: str) -> DataFrame:
    return spark.createDataFrame([(i, reason) for i in ids], "id string, reason string")


def write_artifacts(result: dict[str, DataFrame], out_dir: str, config: Curation, upweights: list[tuple[str, float]] = (), code_dir: str = "accepted_code", single_files: bool = False) -> dict:
    """Kept records, tombstones, splits, accepted code, weights (where rules are given) and report under one shared folder; returns the counts.

    Without any row left after the filter only a report that says so is written.
    """
    spark = result["kept"].sparkSession
    total = result["rows"].count()
    if not total:
        files.write_text(spark, f"{out_dir}/dedup_report.md", sinks.EMPTY_REPORT)
        logger.warning("no records are left after the filters")
        return {"rows": 0}
    write = sinks.write_document if single_files else lambda rows, path, key=None: sinks.write_jsonl(rows, path)
    write(sinks.kept_records(result["kept"]), f"{out_dir}/kept_records.json")
    write(result["tombstones"], f"{out_dir}/tombstones.json", "id")
    write(result["splits"], f"{out_dir}/splits.json", "id")
    sinks.write_code(result["kept"], f"{out_dir}/{code_dir}")
    if upweights:
        sinks.write_weights(result["kept"], list(upweights), f"{out_dir}/sampling_weights.csv")
    records, kept = result["records"].count(), result["kept"].count()
    removed = {r.reason: r.n for r in result["tombstones"].groupBy("reason").agg(F.count("*").alias("n")).orderBy("reason").collect()}
    back = result["kept"].join(result["tombstones"].select("id").distinct(), "id", "left_semi").count()
    counts = {"rows": total, "empty_code_skipped": total - records, **removed, "removed_and_brought_back": back, "kept": kept}
    tables: dict[str, dict] = {"family": {}, "prefix": {}}
    for r in sinks.kept_counts(result["kept"], config.includes).orderBy(F.desc("records"), "value").collect():
        tables[r.kind][r.value] = r.records
    filters = {"Include prefixes": config.includes or "all", "Preferred prefixes": config.preferred or "none"}
    parameters = {k: v for k, v in asdict(config).items() if k not in ("includes", "prefer_order")}
    files.write_text(spark, f"{out_dir}/dedup_report.md", sinks.report(counts, filters, parameters, tables))
    for name, value in {**counts, **{f"kept by {k}": v for k, v in tables.items()}}.items():
        logger.info("%s: %s", name, value)
    return counts
