"""The core's queries by name, and SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.functions import names
from corpusloom.functions.pycode import with_features
from corpusloom.functions.shingles import shingle_hashes, shingles, word_tokens
from corpusloom.operators import chat, exact, retention, similarity, splits
from corpusloom.operators.components import connected_components
from corpusloom.plans import curate as stage1
from corpusloom.sources import sinks
from corpusloom.workspace import Workspace, spread

INCLUDES = ["ResNet", "VGG", "FractalNet", "Res"]
PREFER = ["FractalNet", "ResNet"]
RULES = [("resnet", 2.0), ("Fractal", 1.5), ("res", 3.0)]


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.make_records(_t(spark, sf_dir, "records"))


def prefix_filter(spark, d):
    return _t(spark, d, "records").filter(names.has_prefix(F.col("name"), INCLUDES)).select("row_idx", "name")


def matched_prefix(spark, d):
    name = F.col("name")
    return _t(spark, d, "records").select("row_idx", names.matched_prefix(name, INCLUDES).alias("matched"), names.prefix_rank(name, INCLUDES).cast("int").alias("rank"))


def prefix_diagnostics(spark, d):
    """Per include prefix: the rows whose name begins with it, whatever their code, and the distinct codes of those whose first match it is."""
    name, code = F.col("name"), F.sha2(F.coalesce("code", F.lit("")), 256)
    r = _t(spark, d, "records").select(code.alias("h"), names.matched_prefix(name, INCLUDES).alias("first"), F.explode(F.array_compact(F.array(*[F.when(names.has_prefix(name, [p]), F.lit(p)) for p in INCLUDES]))).alias("prefix"))
    return r.groupBy("prefix").agg(F.count("*").alias("records"), F.count_distinct(F.when(F.col("first") == F.col("prefix"), F.col("h"))).alias("codes"))


def exact_kept(spark, d):
    return exact.kept(exact.exact_groups(_records(spark, d), PREFER)).select("id", "reason", "ord")


def exact_tombstones(spark, d):
    return exact.tombstones(exact.exact_groups(_records(spark, d), PREFER))


def quality_top(spark, d):
    place = F.row_number().over(Window.partitionBy("family_tag").orderBy(*names.quality_order(), "row_idx"))
    return _records(spark, d).withColumn("place", place).filter("place <= 3").select("family_tag", "place", "row_idx")


def families(spark, d):
    code = F.coalesce("code", F.lit(""))
    return _t(spark, d, "records").select("row_idx", names.family_of_source(code).alias("by_source"), names.family_of_model(F.coalesce("name", F.lit("")), code).alias("by_name"))


def word_shingle_counts(spark, d):
    words = _t(spark, d, "documents").select("doc_id", word_tokens(F.col("text")).alias("w"))
    return words.select("doc_id", F.size("w").cast("long").alias("tokens"), F.size(shingles(F.col("w"), 5)).cast("long").alias("shingles"))


def _word_sets(spark, d):
    # the best record of each code: exact copies are gone before anything is compared
    ws = Workspace(spark)
    slim = ws.table(_records(spark, d).drop("code"), "records")
    one = slim.groupBy("code_hash").agg(F.min(exact.quality_key()).alias("k"), F.min_by("family_tag", exact.quality_key()).alias("family"))
    one = ws.table(one.select(F.col("k.row_idx").alias("row_idx"), "family"), "one")
    # each step is a column of its own, or each of its elements would work out the one before once more
    words = spread(_t(spark, d, "records").select("row_idx", "code")).join(one, "row_idx").select(F.col("row_idx").alias("id"), "family", word_tokens(F.col("code")).alias("w"))
    words = words.select("id", "family", F.transform("w", lambda t: F.xxhash64(t)).alias("w"))
    return words.select("id", "family", shingle_hashes(F.col("w"), 10).alias("items"))


def _rounded(links):
    return links.withColumn("similarity", F.round("similarity", 9))


def record_pairs(spark, d):
    """Links between the classes of records with equal sets; record_classes has the members."""
    return _rounded(similarity.similar_classes(_word_sets(spark, d), 0.8)[1])


def record_classes(spark, d):
    return similarity.class_rows(*similarity.similar_classes(_word_sets(spark, d), 0.8), Workspace(spark))


def record_components(spark, d):
    return connected_components(similarity.chained(*similarity.similar_classes(_word_sets(spark, d), 0.8)))


def component_keepers(spark, d):
    ws = Workspace(spark)
    r = _records(spark, d).withColumn("id", F.col("row_idx"))
    components = ws.table(connected_components(similarity.chained(*similarity.similar_classes(_word_sets(spark, d), 0.8, ws=ws)), ws=ws), "components")
    return retention.keep_best(r, components, 1, INCLUDES, ws).select("id", "component", "canonical", "reason")


def record_pairs_lsh(spark, d):
    return _rounded(similarity.lsh_classes(_word_sets(spark, d), 0.8)[1])


def order_basket_similarity(spark, d):
    """Links between classes of orders with equal sets of parts; order_basket_classes has the members."""
    return _rounded(similarity.similar_classes(_baskets(spark, d), 0.6)[1]).drop("family")


def order_basket_classes(spark, d):
    return similarity.class_rows(*similarity.similar_classes(_baskets(spark, d), 0.6), Workspace(spark))


def _baskets(spark, d):
    orders = _t(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("id")).agg(F.collect_set(F.col("l_partkey").cast("string")).alias("items"))
    return orders.select("id", F.lit("all").alias("family"), "items")


def _chat_rows(spark, d):
    c = _t(spark, d, "chat_examples")
    return c.select("id", chat.group_key(F.col("meta"), F.col("id")).alias("group_key"), F.coalesce("meta.family", F.lit("unknown")).alias("family")).distinct()


def _actual_split(c):
    word = F.lower(F.trim(F.col("split")))
    return c.select("id", chat.group_key(F.col("meta"), F.col("id")).alias("group_key"), F.coalesce("meta.family", F.lit("unknown")).alias("family"), F.when(word == "validation", "dev").otherwise(word).alias("split")).distinct()


def family_split(spark, d):
    return splits.family_split(_chat_rows(spark, d), "id", "family")


def item_split(spark, d):
    return splits.item_split(_chat_rows(spark, d), "id", "family")


def grouped_split(spark, d):
    return splits.grouped_split(_chat_rows(spark, d), "group_key", "family", "id")


def source_split(spark, d):
    return splits.source_split(_chat_rows(spark, d), "group_key", "family", "id")


def last_family_split(spark, d):
    return splits.last_family_split(_chat_rows(spark, d), "group_key", "family", "id")


def disjoint_rows(spark, d):
    return splits.enforce_disjoint(_actual_split(_t(spark, d, "chat_examples")), "group_key", "split").select("id", "split")


def split_overlaps(spark, d):
    return splits.overlaps(_actual_split(_t(spark, d, "chat_examples")), "group_key", "split")


def split_manifest(spark, d):
    return sinks.manifest(_actual_split(_t(spark, d, "chat_examples")))


def sampling_weights_out(spark, d):
    return sinks.weights(_records(spark, d), RULES)


def file_names(spark, d):
    return sinks.file_names(_records(spark, d))


def chat_schema_reasons(spark, d):
    c = _t(spark, d, "chat_examples").select("id", chat.schema_reason(F.col("messages")).alias("reason"))
    return c.groupBy("reason").agg(F.count("*").alias("rows"))


def parameter_caps(spark, d):
    return _t(spark, d, "chat_examples").select("id", chat.parameter_cap(F.col("meta.param_estimate")).alias("cap")).distinct()


def chat_checked(spark, d):
    return chat.checked(_t(spark, d, "chat_examples").select("id", "messages", "meta")).groupBy("drop_reason").agg(F.count("*").alias("rows"))


def chat_rendered(spark, d):
    return chat.rendered(_t(spark, d, "chat_examples")).select("id", "prompt", "assistant").distinct()


def structural_near_pairs(spark, d):
    """Of records with distinct fingerprints, links between classes whose bags of calls and settings are alike to 0.9."""
    f = with_features(_one_of_each_code(spark, d), "id", "code").groupBy("fp_hash").agg(F.min(F.struct("id", "bag")).alias("m"))
    sets = f.select(F.col("m.id").alias("id"), F.lit("all").alias("family"), F.col("m.bag").alias("items"))
    return _rounded(similarity.similar_classes(sets, 0.9)[1]).drop("family")


def _one_of_each_code(spark, d):
    r = _records(spark, d)
    return r.join(r.groupBy("code_hash").agg(F.min("row_idx").alias("row_idx")).select("row_idx"), "row_idx").select("id", "code")


def chat_examples_built(spark, d):
    files = _t(spark, d, "records").filter("code is not null").select(F.concat(F.lit("/data/code/"), "id", F.lit(".py")).alias("path"), F.col("code").alias("text"))
    return chat.build_examples(files)[0].select("id", F.col("meta.type").alias("type"), "meta.family", "meta.param_estimate", F.size("messages").alias("messages"))


def code_fingerprints(spark, d):
    f = with_features(_records(spark, d), "id", "code")
    return f.select("id", "fp_hash", F.col("n_tokens").alias("tokens"), F.size("bag").alias("bag"))


def kept_counts(spark, d):
    """Exact-deduplicated records by family and by first include prefix."""
    r = _records(spark, d)
    return sinks.kept_counts(exact.kept(exact.exact_groups(r, PREFER)).select("id").join(r.select("id", "name", "family_tag"), "id"), INCLUDES)


def chat_fixed_answers(spark, d):
    fixed = chat.fixed_answers(_t(spark, d, "chat_examples").select("id", "messages"))
    return fixed.select("id", F.try_element_at(F.filter("messages", lambda m: m["role"] == "assistant"), F.lit(1))["content"].alias("answer")).distinct()


def _curated(spark, d, config):
    return stage1.curate(_t(spark, d, "records").select("row_idx", "name", "code", "accuracy"), config)


def curate_kept(spark, d):
    return _curated(spark, d, stage1.Curation(includes=["ResNet", "FractalNet"], prefer_order=PREFER))["kept"].select("id", "name", "accuracy", "family_tag", "reason")


def curate_tombstones(spark, d):
    return _curated(spark, d, stage1.Curation())["tombstones"]


_QUERIES = (
    prefix_filter, matched_prefix, prefix_diagnostics, exact_kept, exact_tombstones, quality_top, families, word_shingle_counts, record_pairs, record_classes, record_components, component_keepers,
    record_pairs_lsh, order_basket_similarity, order_basket_classes, family_split, item_split, grouped_split, source_split, last_family_split, disjoint_rows, split_overlaps, split_manifest,
    sampling_weights_out, file_names, chat_schema_reasons, parameter_caps, chat_checked, chat_rendered, chat_examples_built, code_fingerprints, structural_near_pairs, kept_counts, chat_fixed_answers, curate_kept, curate_tombstones,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in _QUERIES}


_KEY = "regexp_replace(lower(coalesce(name, '')), '[^a-z0-9]', '', 'g')"


def _has(prefix: str) -> str:
    return f"starts_with({_KEY}, '{names.normal_text(prefix)}')"


def _case(pairs, otherwise: str) -> str:
    return "CASE " + " ".join(f"WHEN {c} THEN {v}" for c, v in pairs) + f" ELSE {otherwise} END"


def _source_family(code: str) -> str:
    return _case([(" OR ".join(f"contains(lower({code}), '{w}')" for w in cues), f"'{tag}'") for tag, cues in names.SOURCE_CUES], "'generic'")


def _model_family(name: str, code: str) -> str:
    return _case([(f"starts_with({name}, '{cue}')", f"'{tag}'") for cue, tag in names.NAME_CUES], _source_family(code))


def _bare(c: str) -> str:
    return rf"regexp_replace({c}, '^[\s\x0B\p{{Z}}\p{{Cf}}]+|[\s\x0B\p{{Z}}\p{{Cf}}]+$', '', 'g')"


def _path(c: str) -> str:
    """A path in one spelling, as names.resolved_path gives it."""
    without = f"regexp_replace({_bare(c)}, '(?i)^file://', '')"
    slashed = rf"replace({_bare(without)}, '\', '/')"
    parts = f"list_filter(string_split(CASE WHEN starts_with({slashed}, '/') THEN '' ELSE '/data/' END || {slashed}, '/'), lambda p: p NOT IN ('', '.'))"
    step = "lambda done, p: CASE WHEN p[1] = '..' THEN done[1 : len(done) - 1] ELSE list_concat(done, p) END"
    resolved = f"list_reduce(list_prepend([]::VARCHAR[], list_transform({parts}, lambda p: [p])), {step})"
    return f"CASE WHEN {slashed} <> '' THEN '/' || array_to_string({resolved}, '/') END"


_REC = f"""rec AS (SELECT sha256(code) || '_' || row_idx AS id, coalesce(name, '') AS name, code, CASE WHEN isnan(accuracy) THEN NULL ELSE accuracy END AS accuracy,
  sha256(code) AS code_hash, row_idx, {_model_family("coalesce(name, '')", 'code')} AS family_tag FROM records WHERE regexp_matches(code, '\\S'))"""
_ORDER = "accuracy DESC NULLS LAST, length(code) DESC, name, row_idx"
_EXACT = f"""{_REC}, ranked AS (SELECT *, first_value(id) OVER w AS canonical, first_value(name) OVER w AS canonical_name, count(*) OVER (PARTITION BY code_hash) AS copies, min(row_idx) OVER (PARTITION BY code_hash) AS ord
  FROM rec WINDOW w AS (PARTITION BY code_hash ORDER BY {_case([(_has(p), i) for i, p in enumerate(PREFER)], '102')}, {_ORDER}))"""
_CLASSES = """sh AS (SELECT DISTINCT id, family, s FROM all_items),
  n AS (SELECT id, count(*) AS n, md5(string_agg(s, chr(1) ORDER BY s)) AS k FROM sh GROUP BY 1),
  cls AS (SELECT id, family, min(id) OVER (PARTITION BY family, k) AS class_id, count(*) OVER (PARTITION BY family, k) AS copies FROM members_ LEFT JOIN n USING (id)),
  rep AS (SELECT sh.id, sh.family, s FROM sh JOIN cls USING (id) WHERE id = class_id),
  inter AS (SELECT a.id AS a, b.id AS b, a.family, count(*) AS i FROM rep a JOIN rep b ON a.s = b.s AND a.family = b.family AND a.id < b.id GROUP BY 1, 2, 3),
  pairs AS (SELECT a, b, family, i / (x.n + y.n - i)::DOUBLE AS similarity FROM inter JOIN n x ON x.id = a JOIN n y ON y.id = b WHERE i / (x.n + y.n - i)::DOUBLE >= {threshold} - 1e-9)"""
_SETS = f"""{_REC}, one AS (SELECT row_idx FROM rec QUALIFY row_number() OVER (PARTITION BY code_hash ORDER BY {_ORDER}) = 1),
  members_ AS (SELECT row_idx AS id, family_tag AS family, regexp_extract_all(lower(code), '[a-z0-9_]+') AS w FROM rec JOIN one USING (row_idx)),
  all_items AS (SELECT id, family, array_to_string(w[i : i + 9], ' ') AS s FROM (SELECT id, family, w, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS i FROM members_ WHERE len(w) > 0)),
  {_CLASSES.format(threshold=0.8)}"""
_BASKETS = f"""members_ AS (SELECT DISTINCT l_orderkey AS id, 'all' AS family FROM lineitem),
  all_items AS (SELECT l_orderkey AS id, 'all' AS family, l_partkey::VARCHAR AS s FROM lineitem), {_CLASSES.format(threshold=0.6)}"""
_CLASS_ROWS = """SELECT id, class_id, copies, coalesce(links, 0)::BIGINT AS links FROM cls LEFT JOIN
  (SELECT c, count(*) AS links FROM (SELECT a AS c FROM pairs UNION ALL SELECT b FROM pairs) GROUP BY 1) d ON c = class_id"""
_COMP = f"""{_SETS}, chained AS (SELECT a, b FROM pairs UNION SELECT class_id, id FROM cls WHERE id <> class_id), both_ways AS (SELECT a, b FROM chained UNION SELECT b, a FROM chained),
  reach AS (SELECT a, b FROM both_ways UNION SELECT r.a, e.b FROM reach r JOIN both_ways e ON r.b = e.a),
  comp AS (SELECT a AS node, least(a, min(b)) AS component FROM reach GROUP BY a)"""
_GROUP = f"coalesce(CASE WHEN trim(meta.group_key) <> '' THEN meta.group_key END, {_path('meta.source_path')}, 'NA::' || id)"
_CHAT = f"rows_ AS (SELECT DISTINCT id, {_GROUP} AS group_key, coalesce(meta.family, 'unknown') AS family FROM chat_examples)"
_ACTUAL = f"""rows_ AS (SELECT DISTINCT id, {_GROUP} AS group_key, coalesce(meta.family, 'unknown') AS family,
  CASE WHEN lower(trim(split)) = 'validation' THEN 'dev' ELSE lower(trim(split)) END AS split FROM chat_examples)"""
_MAJOR = """major AS (SELECT group_key, family FROM (SELECT group_key, family, row_number() OVER (PARTITION BY group_key ORDER BY count(*) DESC, min(id)) AS k FROM rows_ GROUP BY 1, 2) WHERE k = 1)"""


def _placed(source: str, key: str, stratum: str) -> str:
    over = f"PARTITION BY {stratum}" if stratum else ""
    return f"placed AS (SELECT *, row_number() OVER ({over} ORDER BY sha256('42:' || {key}), {key}) AS place, count(*) OVER ({over}) AS n FROM {source})"


_ROUND = "CASE WHEN place <= round_even(n * 0.8::DOUBLE, 0) THEN 'train' WHEN place <= round_even(n * 0.8::DOUBLE, 0) + round_even(n * 0.1::DOUBLE, 0) THEN 'dev' ELSE 'test' END"
_FLOOR = """CASE WHEN n = 1 THEN 'train' WHEN n = 2 THEN CASE WHEN place = 1 THEN 'train' ELSE 'test' END WHEN place <= t2 THEN 'train' WHEN place <= t2 + d2 THEN 'dev' ELSE 'test' END"""


def oracle_sql() -> dict[str, str]:
    rank = _case([(_has(p), i) for i, p in enumerate(INCLUDES)], str(len(INCLUDES) + names.UNRANKED))
    by_name = _model_family("coalesce(name, '')", "coalesce(code, '')")
    any_prefix = " OR ".join(map(_has, INCLUDES))
    first = _case([(_has(p), repr(p)) for p in INCLUDES], "NULL")
    overlap = lambda a, b: f"coalesce(sum({a} * {b}), 0)::BIGINT AS {a}_{b}_overlap"
    return {
        "prefix_filter": f"SELECT row_idx, name FROM records WHERE {any_prefix}",
        "matched_prefix": f"SELECT row_idx, {_case([(_has(p), repr(p)) for p in INCLUDES], 'NULL')} AS matched, ({rank})::INT AS rank FROM records",
        "prefix_diagnostics": f"WITH p AS (SELECT *, {first} AS first FROM records) "
        + " UNION ALL ".join(f"SELECT '{p}' AS prefix, count(*) AS records, count(DISTINCT CASE WHEN first = '{p}' THEN coalesce(code, '') END) AS codes FROM p WHERE {_has(p)} HAVING count(*) > 0" for p in INCLUDES),
        "exact_kept": f"WITH {_EXACT} SELECT id, CASE WHEN copies > 1 THEN 'canonical_of_exact_group' ELSE 'unique' END AS reason, ord FROM ranked WHERE id = canonical",
        "exact_tombstones": f"WITH {_EXACT} SELECT id, canonical, 'exact_duplicate' AS reason, name, canonical_name FROM ranked WHERE id <> canonical",
        "quality_top": f"WITH {_REC} SELECT family_tag, place, row_idx FROM (SELECT *, row_number() OVER (PARTITION BY family_tag ORDER BY {_ORDER})::INT AS place FROM rec) WHERE place <= 3",
        "families": f"SELECT row_idx, {_source_family(chr(99) + 'oalesce(code, ' + repr('') + ')')} AS by_source, {by_name} AS by_name FROM records",
        "word_shingle_counts": """WITH w AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[a-z0-9_]+') AS w FROM documents),
  s AS (SELECT doc_id, count(DISTINCT array_to_string(w[i : i + 4], ' ')) AS c FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 4, 1))) AS i FROM w WHERE len(w) > 0) GROUP BY 1)
  SELECT doc_id, len(w)::BIGINT AS tokens, coalesce(c, 0)::BIGINT AS shingles FROM w LEFT JOIN s USING (doc_id)""",
        "record_pairs": f"WITH {_SETS} SELECT a, b, family, round(similarity, 9) AS similarity FROM pairs",
        "record_classes": f"WITH {_SETS} {_CLASS_ROWS}",
        "record_components": f"WITH RECURSIVE {_COMP} SELECT node, component FROM comp",
        "component_keepers": f"""WITH RECURSIVE {_COMP}, member AS (SELECT rec.* EXCLUDE (id), row_idx AS id, component, {first} AS first FROM rec JOIN comp ON node = row_idx),
  placed AS (SELECT *, row_number() OVER (PARTITION BY component ORDER BY {_ORDER}) AS k, first_value(id) OVER (PARTITION BY component ORDER BY {_ORDER}) AS canonical,
    row_number() OVER (PARTITION BY component, first ORDER BY {_ORDER}) AS kp FROM member),
  best AS (SELECT * FROM placed WHERE k <= 1),
  stay AS (SELECT id FROM best UNION SELECT id FROM placed p WHERE first IS NOT NULL AND kp = 1 AND NOT EXISTS (SELECT 1 FROM best b WHERE b.component = p.component AND b.first = p.first))
  SELECT id, component, canonical, CASE WHEN id IN (SELECT id FROM stay) THEN NULL ELSE 'lexical_near_duplicate' END AS reason FROM placed""",
        "order_basket_similarity": f"WITH {_BASKETS} SELECT a, b, round(similarity, 9) AS similarity FROM pairs",
        "order_basket_classes": f"WITH {_BASKETS} {_CLASS_ROWS}",
        "kept_counts": f"""WITH {_EXACT}, k AS (SELECT family_tag, {first} AS first FROM ranked WHERE id = canonical)
  SELECT 'family' AS kind, family_tag AS value, count(*) AS records FROM k GROUP BY 2 UNION ALL SELECT 'prefix', first, count(*) FROM k WHERE first IS NOT NULL GROUP BY 2""",
        "chat_fixed_answers": r"""WITH a AS (SELECT DISTINCT id, list_filter(messages, lambda m: m.role = 'assistant')[1] AS m FROM chat_examples), c AS (SELECT id, m, coalesce(m.content, '') AS t FROM a),
  b AS (SELECT id, m, CASE WHEN regexp_matches(t, '(?s)```python\s*(.*?)```') THEN regexp_extract(t, '(?s)```python\s*(.*?)```', 1)
    WHEN regexp_matches(t, '(?s)```\s*(.*?)```') THEN regexp_extract(t, '(?s)```\s*(.*?)```', 1) ELSE t END AS code FROM c)
  SELECT DISTINCT id, CASE WHEN m IS NOT NULL THEN '```python' || chr(10) || regexp_replace(code, '^[\s\x0B\x1C-\x1F\x{85}\p{Z}]+|[\s\x0B\x1C-\x1F\x{85}\p{Z}]+$', '', 'g') || chr(10) || '```' END AS answer FROM b""",
        "family_split": f"WITH {_CHAT}, f AS (SELECT DISTINCT family FROM rows_), {_placed('f', 'family', '')} SELECT id, {_ROUND} AS split FROM rows_ JOIN placed USING (family)",
        "item_split": f"WITH {_CHAT}, {_placed('rows_', 'id', 'family')} SELECT id, {_ROUND} AS split FROM placed",
        "grouped_split": f"""WITH {_CHAT}, {_MAJOR}, {_placed('major', 'group_key', 'family')},
  c AS (SELECT *, floor(n * 0.8::DOUBLE + 1e-12) AS t, floor(n * 0.1::DOUBLE + 1e-12) AS d FROM placed),
  e AS (SELECT *, CASE WHEN n - t - d = 0 AND d > 1 THEN d - 1 ELSE d END AS d2, CASE WHEN n - t - d = 0 AND d <= 1 AND t > 1 THEN t - 1 ELSE t END AS t2 FROM c)
  SELECT group_key, {_FLOOR} AS split FROM e""",
        "source_split": f"WITH {_CHAT}, {_MAJOR}, {_placed('major', 'group_key', 'family')} SELECT group_key, {_ROUND} AS split FROM placed",
        "last_family_split": f"""WITH {_CHAT}, p AS (SELECT DISTINCT group_key, family FROM rows_), {_placed('p', 'group_key', 'family')}, f AS (SELECT family, min(id) AS fo FROM rows_ GROUP BY 1)
  SELECT group_key, arg_max({_ROUND}, fo) AS split FROM placed JOIN f USING (family) GROUP BY 1""",
        "disjoint_rows": f"""WITH {_ACTUAL}, r AS (SELECT *, CASE split WHEN 'train' THEN 1 WHEN 'dev' THEN 2 WHEN 'test' THEN 3 END AS k FROM rows_)
  SELECT id, split FROM (SELECT *, min(k) OVER (PARTITION BY group_key) AS m FROM r) WHERE k = m""",
        "split_overlaps": f"""WITH {_ACTUAL}, g AS (SELECT group_key, max((split = 'train')::INT) AS train, max((split = 'dev')::INT) AS dev, max((split = 'test')::INT) AS test FROM rows_ GROUP BY 1)
  SELECT {overlap('train', 'dev')}, {overlap('train', 'test')}, {overlap('dev', 'test')} FROM g""",
        "split_manifest": f"WITH {_ACTUAL} SELECT split, family, count(*) AS rows, count(DISTINCT group_key) AS sources FROM rows_ GROUP BY 1, 2",
        "sampling_weights_out": f"WITH {_REC} SELECT id, name, {_case([(f'starts_with(lower(name), {p.lower()!r})', f'{w}::DOUBLE') for p, w in RULES], '1.0::DOUBLE')} AS weight FROM rec",
        "file_names": f"""WITH {_REC}, b AS (SELECT id, regexp_replace(replace(regexp_replace(name, '^[\\s\\x0B]+|[\\s\\x0B]+$', '', 'g'), ' ', '_'), '[^a-zA-Z0-9._-]+', '', 'g') AS s FROM rec),
  f AS (SELECT id, (CASE WHEN s = '' THEN 'model' ELSE s END) || '__' || id[1:12] AS base FROM b), k AS (SELECT *, row_number() OVER (PARTITION BY base ORDER BY id) AS p FROM f)
  SELECT id, base || CASE WHEN p > 1 THEN '_' || (p - 1) ELSE '' END || '.py' AS file_name FROM k""",
        "chat_schema_reasons": """WITH r AS (SELECT CASE WHEN coalesce(len(messages), 0) <> 3 THEN 'bad_schema_len'
  WHEN NOT coalesce(messages[1].role = 'system' AND messages[2].role = 'user' AND messages[3].role = 'assistant', false) THEN 'bad_roles' END AS reason FROM chat_examples)
  SELECT reason, count(*) AS rows FROM r GROUP BY 1""",
        "chat_rendered": """SELECT DISTINCT id, array_to_string(list_transform(messages[1 : greatest(len(messages) - 1, 0)],
  lambda m: '<|' || coalesce(m.role, '') || '|>' || chr(10) || coalesce(m.content, '') || chr(10)), '') || '<|assistant|>' || chr(10) AS prompt, messages[len(messages)].content AS assistant FROM chat_examples""",
        "parameter_caps": "WITH p AS (SELECT DISTINCT id, floor(greatest(coalesce(meta.param_estimate, 50000), 50000) * 1.3::DOUBLE) AS x FROM chat_examples) SELECT id, ("
        + _case([(f"x <= {b}", b) for b in chat.PARAMETER_BUCKETS], str(chat.PARAMETER_BUCKETS[-1]))
        + ")::BIGINT AS cap FROM p",
    }
