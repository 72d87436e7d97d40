"""Joins, sets, aggregations, metrics, windows and samples (groups D, E and F)."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import constants as K
from ..functions import features, urls
from ..operators import cluster, history, metrics, prepare, sampling, split
from ..plans import joins, ordered
from ..sources import registry
from . import inputs as I, sql as S
from .registry import query

LARGER, SMALLER = registry.SOURCES["larger"], registry.SOURCES["smaller"]


def inspected(spark, sf_dir):
    return I.held(spark, sf_dir, "inspected", lambda s, d: ordered.cut(
        prepare.inspected(I.raw(s, d), LARGER)))


def routes(spark, sf_dir):
    return prepare.routed(I.raw(spark, sf_dir), LARGER)


def edge_routes(spark, sf_dir):
    return prepare.routed(I.raw_edges(spark, sf_dir), LARGER)


def outputs(spark, sf_dir, name, make):
    """The four outputs of a preparation run, from routed and featured rows kept on disk."""
    found = I.held(spark, sf_dir, name, lambda s, d: ordered.cut(make(s, d)))
    scored = I.held(spark, sf_dir, name + "_featured", lambda s, d: ordered.cut(prepare.featured(found)))
    return prepare.split_routes(found, scored, "larger")


def labelled_groups(spark, sf_dir):
    """The URL list with label, group, split and row number, shared by several queries."""
    def make(spark, sf_dir):
        rows = I.raw(spark, sf_dir).withColumn(
            "label", F.when(F.col("original_label") == "benign", 0).otherwise(1))
        return ordered.cut(split.assign(rows, rules=I.RULES).select(
            F.col("source_row").alias("row_number"), "l_suppkey", "url", "label", "domain_group", "split"))
    return I.held(spark, sf_dir, "groups", make)


GROUPED = (S.raw(I.URLS_V) + "," + S.parse() + "," + S.grouped().replace("grouped as (", "all_groups as (")
           + """, grouped as (select source_row as row_number, l_suppkey, url, domain_group, split,
 case when original_label = 'benign' then 0 else 1 end as label from all_groups)""")


def clustered(spark, sf_dir):
    return I.table(spark, sf_dir, "embeddings").select(
        "vec_id", F.col("label").alias("cluster"), F.col("embedding").cast("array<double>").alias("values"))


DIMS = 64


CLUSTERS = range(10)


def wide_clusters(spark, sf_dir):
    """One column per value; a vector of another length than the queries' is an error."""
    values = F.when(F.size("values") == DIMS, F.col("values")).otherwise(
        F.raise_error(F.lit(f"Expected vectors of {DIMS} values")))
    rows = clustered(spark, sf_dir).withColumn("values", values)
    return rows.select("vec_id", "cluster", F.lit(1).alias("label"), *[
        F.col("values")[i].alias(f"f{i:02d}") for i in range(DIMS)])


FEATURE_NAMES = [f"f{i:02d}" for i in range(DIMS)]
PROFILE = S.CLUSTERED + """,
overall as (select f, avg(v::double) as om, stddev_pop(v::double) as os from tall group by f),
means as (select cluster, f, avg(v::double) as cm from tall group by cluster, f),
profile as (select cluster, concat('f', lpad((m.f - 1)::varchar, 2, '0')) as feature, m.f - 1 as feature_index, cm, om,
 (cm - om) / case when os = 0 then 1 else os end as d from means m join overall o on m.f = o.f),
ranked as (select *, row_number() over (partition by cluster order by abs(d) desc, feature_index) as rank from profile)"""


# --- D. projections, joins, sets ----------------------------------------------

@query("d01_rename_project", f"""
select 'larger' as dataset, url, original_label as original_category from ({I.URLS_V}) v""")
def d01(spark, sf_dir):
    return I.view(spark, sf_dir, I.URLS_V).select(
        F.lit("larger").alias("dataset"), "url", F.col("original_label").alias("original_category"))


@query("d02_valid_invalid", S.with_(S.prepared(I.EDGE_V), """
 select reason = '' as valid, count(*) as rows, sum(source_row)::bigint as row_sum from routes group by 1"""))
def d02(spark, sf_dir):
    rows = prepare.inspected(I.raw_edges(spark, sf_dir), LARGER)
    return rows.groupBy((F.col("reason") == "").alias("valid")).agg(
        F.count("*").alias("rows"), F.sum("source_row").alias("row_sum"))


@query("d03_conflicting_rows", S.with_(S.prepared(), "select source_row, url from routes where route = 'conflict'"))
def d03(spark, sf_dir):
    rows = inspected(spark, sf_dir)
    return joins.lookup(rows, prepare.conflicting_keys(rows), "url_key", "left_semi").select("source_row", "url")


@query("d04_eligible_rows", S.with_(S.prepared(), """
 select source_row, url from routes where route in ('kept', 'duplicate')"""))
def d04(spark, sf_dir):
    return prepare.eligible(inspected(spark, sf_dir)).select("source_row", "url")


@query("d05_cross_source_anti", S.with_(GROUPED, """
 select row_number, url, domain_group from grouped where l_suppkey % 3 = 0 and domain_group not in
  (select domain_group from grouped where l_suppkey % 2 = 0)"""))
def d05(spark, sf_dir):
    rows = labelled_groups(spark, sf_dir)
    target, source = rows.where("l_suppkey % 3 = 0"), rows.where("l_suppkey % 2 = 0")
    return split.outside_source(target, source).select("row_number", "url", "domain_group")


@query("d05_cross_source_counts", S.with_(GROUPED, """
 select count_if(domain_group not in (select domain_group from grouped where l_suppkey % 2 = 0))::bigint as kept_rows,
 count_if(domain_group in (select domain_group from grouped where l_suppkey % 2 = 0))::bigint as excluded_rows
 from grouped where l_suppkey % 3 = 0"""))
def d05_counts(spark, sf_dir):
    rows = labelled_groups(spark, sf_dir)
    source = rows.where("l_suppkey % 2 = 0").select("domain_group").distinct().withColumn("known", F.lit(True))
    joined = joins.lookup(rows.where("l_suppkey % 3 = 0"), source, "domain_group")
    return joined.agg(F.count_if(F.col("known").isNull()).alias("kept_rows"),
                      F.count_if("known").alias("excluded_rows"))


@query("d06_left_lookup", S.with_(S.prepared(), """
 select source_row, records, categories from routes where route = 'kept'"""))
def d06(spark, sf_dir):
    return routes(spark, sf_dir).where("route = 'kept'").select("source_row", "records", "categories")


@query("d07_group_split_map", S.with_(GROUPED, "select distinct domain_group, split from grouped"))
def d07(spark, sf_dir):
    return labelled_groups(spark, sf_dir).select("domain_group", "split").distinct()


@query("d08_row_aligned_concat", S.with_(S.raw(I.URLS_V), S.parse(), """
 select source_row, original_label, length(u) as url_length, length(host) as hostname_length from parsed"""))
def d08(spark, sf_dir):
    left = I.raw(spark, sf_dir)
    right = features.with_features(left.select("source_row", "url")).select(
        "source_row", "url_length", "hostname_length")
    return left.select("source_row", "original_label").join(right, "source_row")


@query("d09_alignment", S.with_(GROUPED, """
 numbered as (select split, row_number() over (partition by split order by row_number) as n from grouped)""", """
 select split, count(*) as rows, min(n) as low, max(n) as high, count(distinct n) as distinct_numbers,
 true as contiguous from numbered group by split"""))
def d09(spark, sf_dir):
    return split.assignments_aligned(split.with_split_row_number(labelled_groups(spark, sf_dir)))


@query("d09_differing_rows", """
with l as (select user_id, event_type, count(*) as n from events group by all),
r as (select user_id, case when event_type = 'error' then 'click' else event_type end as event_type, count(*) as n
 from events group by all)
select coalesce(l.user_id, r.user_id) as user_id, coalesce(l.event_type, r.event_type) as event_type,
 coalesce(l.n, 0) - coalesce(r.n, 0) as surplus
from l full join r on l.user_id = r.user_id and l.event_type = r.event_type
where coalesce(l.n, 0) <> coalesce(r.n, 0)""")
def d09_differing(spark, sf_dir):
    left = I.table(spark, sf_dir, "events").select("user_id", "event_type")
    right = left.withColumn("event_type", F.when(F.col("event_type") == "error", "click")
                            .otherwise(F.col("event_type")))
    return split.differing_rows(left, right)


@query("d10_union_all", f"""
select 'list' as origin, url from ({I.URLS_V}) v union all select 'page', url from pages""")
def d10(spark, sf_dir):
    lists = I.view(spark, sf_dir, I.URLS_V).select(F.lit("list").alias("origin"), "url")
    return lists.unionByName(I.pages(spark, sf_dir).select(F.lit("page").alias("origin"), "url"))


@query("d11_leaking_groups", S.with_(GROUPED, """
 select domain_group from grouped group by domain_group having count(distinct split) > 1"""))
def d11(spark, sf_dir):
    return split.leaking_groups(labelled_groups(spark, sf_dir))


@query("d11_shared_groups", S.with_(GROUPED, """
 select domain_group from grouped where l_suppkey % 3 = 0 intersect
 select domain_group from grouped where l_suppkey % 2 = 0"""))
def d11_shared(spark, sf_dir):
    rows = labelled_groups(spark, sf_dir)
    return split.shared_groups(rows.where("l_suppkey % 3 = 0"), rows.where("l_suppkey % 2 = 0"))


@query("d12_unknown_labels", f"""
select distinct lower(trim(original_label)) as label from ({I.EDGE_V}) e
where lower(trim(original_label)) not in ('', '0', '1')""")
def d12(spark, sf_dir):
    return prepare.unknown_labels(I.raw_edges(spark, sf_dir), SMALLER)


@query("d13_class_filter", S.with_(GROUPED, "select row_number, url from grouped where split = 'train' and label = 1"))
def d13(spark, sf_dir):
    rows = features.with_features(labelled_groups(spark, sf_dir).where("split = 'train'"))
    return cluster.select_class(rows).select("row_number", "url")


@query("d14_history_search", S.with_(S.HISTORY, f"""
 select id, url from history where contains(lower(url), lower('CLICK1')) and {S.SHOWN} = 'Dangerous'"""))
def d14(spark, sf_dir):
    return history.search(I.history(spark, sf_dir), "CLICK1", "Dangerous").select("id", "url")


@query("d15_point_lookup", S.with_(S.HISTORY, "select id, url, trust_score, status from history where id = 777"))
def d15(spark, sf_dir):
    return history.get(I.history(spark, sf_dir), 777).select("id", "url", "trust_score", "status")


METRICS_SQL = S.SCORED + f"""
, counts as (select model, uses_https, {S.CONFUSION} from scored group by model, uses_https),
f1s as (select *, case when 2 * tp + fp + fn = 0 then 0.0 else 2 * tp / (2 * tp + fp + fn) end as f1 from counts)"""


@query("d16_metric_change", S.with_(METRICS_SQL, """
 select a.model, round(a.f1, 9) as f1, round(a.f1 - b.f1, 9) as f1_change from f1s a join f1s b
 on a.model = b.model and b.uses_https = 0 where a.uses_https = 1"""))
def d16(spark, sf_dir):
    full = metrics.threshold_metrics(metrics.confusion(I.scored(spark, sf_dir), ["model", "uses_https"]))
    changed = metrics.change(full.where("uses_https = 1"), full.where("uses_https = 0"), ["model"])
    return changed.select("model", F.round("f1", 9).alias("f1"), F.round("f1_change", 9).alias("f1_change"))


# --- E. aggregations ----------------------------------------------------------

@query("e01_value_counts", S.with_(S.prepared(I.EDGE_V), """
 select 'reason' as what, reason as value, count(*) as rows from routes group by reason
 union all select 'category', original_category, count(*) from routes group by original_category
 union all select 'label', label::varchar, count(*) from routes group by label"""))
def e01(spark, sf_dir):
    rows = prepare.inspected(I.raw_edges(spark, sf_dir), LARGER)
    pairs = F.array(*[F.struct(F.lit(w).alias("what"), F.col(c).cast("string").alias("value")) for w, c in
                      (("reason", "reason"), ("category", "original_category"), ("label", "label"))])
    return rows.select(F.inline(pairs)).groupBy("what", "value").agg(F.count("*").alias("rows"))


@query("e02_conflicting_keys", S.with_(S.prepared(), "select url_key from keys where labels > 1"))
def e02(spark, sf_dir):
    return prepare.conflicting_keys(inspected(spark, sf_dir))


@query("e03_keep_first", S.with_(S.prepared(), "select source_row, url, label from routes where route = 'kept'"))
def e03(spark, sf_dir):
    return routes(spark, sf_dir).where("route = 'kept'").select("source_row", "url", "label")


@query("e04_category_sets", S.with_(S.prepared(), """
 select url_key, categories from keys where records > 1"""))
def e04(spark, sf_dir):
    return prepare.repeated_keys(inspected(spark, sf_dir), LARGER).select(
        "url_key", "categories")


@query("e05_records_per_key", S.with_(S.prepared(), "select url_key, records from keys where records > 1"))
def e05(spark, sf_dir):
    return prepare.repeated_keys(inspected(spark, sf_dir), LARGER).select(
        "url_key", "records")


@query("e06_reconciliation", S.with_(S.prepared(I.EDGE_V), """
 select count(*) as input_rows, count_if(route in ('invalid', 'conflict'))::bigint as excluded_rows,
 count_if(route = 'duplicate')::bigint as duplicate_rows, count_if(route = 'kept')::bigint as output_rows,
 0::bigint as missing_keys, true as reconciled from routes"""))
def e06(spark, sf_dir):
    return prepare.reconcile(edge_routes(spark, sf_dir))


@query("e07_preparation_summary", S.with_(S.prepared(I.EDGE_V), """
 select count(*) as input_rows, count_if(route = 'kept')::bigint as output_rows,
 count_if(route = 'kept' and label = 0)::bigint as output_label_0,
 count_if(route = 'kept' and label = 1)::bigint as output_label_1,
 count_if(trimmed)::bigint as outer_whitespace_trimmed_rows, count_if(route = 'invalid')::bigint as invalid_rows,
 count(distinct case when route = 'conflict' then url_key end) as conflicting_url_keys,
 count_if(route = 'conflict')::bigint as conflicting_label_rows,
 count_if(route = 'duplicate')::bigint as duplicate_rows from routes"""))
def e07(spark, sf_dir):
    return prepare.summary(edge_routes(spark, sf_dir))


@query("e08_split_statistics", S.with_(GROUPED, """
 select split, count(*) as rows, count(distinct domain_group) as domain_groups,
 count_if(label = 0)::bigint as label_0_rows, count_if(label = 1)::bigint as label_1_rows,
 round(100 * count(*) / (select count(*) from grouped), 2) as row_percent from grouped group by split"""))
def e08(spark, sf_dir):
    return split.statistics(labelled_groups(spark, sf_dir))


@query("e09_confusion", S.with_(S.SCORED, f"select model, {S.CONFUSION} from scored group by model"))
def e09(spark, sf_dir):
    return metrics.confusion(I.scored(spark, sf_dir), ["model"])


@query("e10_threshold_metrics", S.with_(S.SCORED, f"counts as (select model, {S.CONFUSION} from scored group by model)", """
 select model, tn, fp, fn, tp, round((tn + tp) / (tn + fp + fn + tp), 9) as accuracy,
 round((tp / (tp + fn) + tn / (tn + fp)) / 2, 9) as balanced_accuracy,
 round(tp / (tp + fp), 9) as precision, round(tp / (tp + fn), 9) as recall,
 round(2 * tp / (2 * tp + fp + fn), 9) as f1 from counts"""))
def e10(spark, sf_dir):
    full = metrics.threshold_metrics(metrics.confusion(I.scored(spark, sf_dir), ["model"]))
    return full.select("model", "tn", "fp", "fn", "tp", *[
        F.round(c, 9).alias(c) for c in ("accuracy", "balanced_accuracy", "precision", "recall", "f1")])


@query("e11_roc_auc", S.with_(S.SCORED, S.RANKED, """
 select model, round(sum(neg / nn * (cum_tp - pos / 2) / np), 9) as roc_auc from cums group by model"""))
def e11(spark, sf_dir):
    return metrics.ranking_metrics(I.scored(spark, sf_dir), ["model"]).select(
        "model", F.round("roc_auc", 9).alias("roc_auc"))


@query("e12_average_precision", S.with_(S.SCORED, S.RANKED, """
 select model, round(sum(pos / np * cum_tp / (cum_tp + cum_fp)), 9) as average_precision from cums group by model"""))
def e12(spark, sf_dir):
    return metrics.ranking_metrics(I.scored(spark, sf_dir), ["model"]).select(
        "model", F.round("average_precision", 9).alias("average_precision"))


@query("e12_binary_metrics", S.with_(S.SCORED, S.RANKED, f"""
counts as (select model, {S.CONFUSION} from scored group by model),
ranks as (select model, round(sum(neg / nn * (cum_tp - pos / 2) / np), 9) as roc_auc,
 round(sum(pos / np * cum_tp / (cum_tp + cum_fp)), 9) as average_precision from cums group by model)""", """
 select c.model, tn, fp, fn, tp, round(2 * tp / (2 * tp + fp + fn), 9) as f1, roc_auc, average_precision
 from counts c join ranks r on c.model = r.model"""))
def e12_all(spark, sf_dir):
    full = metrics.binary_metrics(I.scored(spark, sf_dir), by=["model"])
    return full.select("model", "tn", "fp", "fn", "tp", *[
        F.round(c, 9).alias(c) for c in ("f1", "roc_auc", "average_precision")])


@query("e13_curve_points", S.with_(S.SCORED, S.RANKED, """
 select model, p as score, cum_tp::bigint as cum_tp, cum_fp::bigint as cum_fp,
 round(cum_fp / nn, 9) as false_positive_rate, round(cum_tp / np, 9) as recall,
 round(cum_tp / (cum_tp + cum_fp), 9) as precision from cums"""))
def e13(spark, sf_dir):
    points = metrics.curve_points(I.scored(spark, sf_dir), ["model"])
    return points.select("model", "score", "cum_tp", "cum_fp", *[
        F.round(c, 9).alias(c) for c in ("false_positive_rate", "recall", "precision")])


@query("e14_subgroups", S.with_(S.SCORED, f"""
flags as (select distinct model, flag from scored, (values (0), (1)) f(flag)),
counts as (select model, uses_https, {S.CONFUSION} from scored group by model, uses_https)""", """
 select f.model as variant, f.flag as uses_https, coalesce(tn + fp + fn + tp, 0) as rows,
 coalesce(tn + fp, 0) as label_0_rows, coalesce(fn + tp, 0) as label_1_rows, coalesce(tn, 0) as tn,
 coalesce(fp, 0) as fp, coalesce(fn, 0) as fn, coalesce(tp, 0) as tp,
 round((tn + tp) / nullif(tn + fp + fn + tp, 0), 9) as accuracy, round(tp / nullif(tp + fn, 0), 9) as recall,
 round(fp / nullif(fp + tn, 0), 9) as false_positive_rate
 from flags f left join counts c on f.model = c.model and f.flag = c.uses_https"""))
def e14(spark, sf_dir):
    rows = metrics.subgroup_metrics(I.scored(spark, sf_dir).withColumnRenamed("model", "variant"))
    rates = ["accuracy", "recall", "false_positive_rate"]
    return rows.select(*[c for c in rows.columns if c not in rates],
                       *[F.round(c, 9).alias(c) for c in rates])


@query("e15_flag_share", S.with_(GROUPED, """
 select split, label, count(*) as rows, count_if(url like 'https:%')::bigint as https_rows,
 round(count_if(url like 'https:%') / count(*), 9) as https_share from grouped group by split, label"""))
def e15(spark, sf_dir):
    shares = metrics.flag_share(features.with_features(labelled_groups(spark, sf_dir)))
    return shares.withColumn("https_share", F.round("https_share", 9))


@query("e16_class_weights", S.with_(GROUPED, """
 select label, round(any_value(n) / (2 * count(*)), 9) as weight from grouped,
 (select count(*) as n from grouped where split = 'train') where split = 'train' group by label"""))
def e16(spark, sf_dir):
    weights = metrics.class_weight_table(labelled_groups(spark, sf_dir).where("split = 'train'"))
    return weights.withColumn("weight", F.round("weight", 9))


@query("e17_class_prior", S.with_(GROUPED, "select round(avg(label), 9) as probability from grouped where split = 'train'"))
def e17(spark, sf_dir):
    train = labelled_groups(spark, sf_dir).where("split = 'train'")
    return metrics.majority_probability(train).select(F.round("probability", 9).alias("probability"))


@query("e18_cluster_summary", """
select label as cluster, count(*) as rows, round(100 * count(*) / (select count(*) from embeddings), 9) as share_percent,
 0::bigint as label_0_rows, count(*) as label_1_rows, 1.0 as label_1_share from embeddings group by label""")
def e18(spark, sf_dir):
    rows = cluster.cluster_summary(wide_clusters(spark, sf_dir))
    return rows.withColumn("share_percent", F.round("share_percent", 9))


def profile_rows(spark, sf_dir):
    return cluster.profile(wide_clusters(spark, sf_dir), FEATURE_NAMES)


@query("e19_cluster_profile", S.with_(PROFILE, """
 select cluster, feature, rank, round(cm, 6) as cluster_mean, round(om, 6) as overall_class_mean,
 round(d, 6) as standardized_difference, case when d > 0 then 'higher' when d < 0 then 'lower' else 'same' end as direction
 from ranked"""))
def e19(spark, sf_dir):
    rows = profile_rows(spark, sf_dir)
    numbers = ["cluster_mean", "overall_class_mean", "standardized_difference"]
    return rows.select("cluster", "feature", "rank", "direction", *[F.round(c, 6).alias(c) for c in numbers])


@query("e20_difference_pivot", S.with_(PROFILE, "select feature, " + ", ".join(
    f"round(max(case when cluster = {c} then d end), 6) as c{c}" for c in range(10)) + " from ranked group by feature"))
def e20(spark, sf_dir):
    rows = profile_rows(spark, sf_dir).withColumn("cluster", F.when(
        F.col("cluster").isin(*CLUSTERS), F.col("cluster")).otherwise(
        F.raise_error(F.concat(F.lit("No column for cluster "), F.coalesce(F.col("cluster").cast("string"), F.lit("null"))))))
    table = cluster.difference_table(rows, list(CLUSTERS))
    return table.select("feature", *[F.round(F.col(f"`{c}`"), 6).alias(f"c{c}") for c in CLUSTERS])


SILHOUETTE = """
pairs as (select a.vec_id, a.label as own, b.label as other, sum(list_distance(a.embedding::double[], b.embedding::double[])) as total,
 count(*) as n from embeddings a, embeddings b group by a.vec_id, a.label, b.label),
parts as (select vec_id, max(case when own = other then case when n = 1 then null else total / (n - 1) end end) as a,
 min(case when own <> other then total / n end) as b from pairs group by vec_id),
widths as (select vec_id, case when a is null then 0 else (b - a) / greatest(a, b) end as width from parts)"""


@query("e22_silhouette", f"with {SILHOUETTE.strip()} select round(avg(width), 6) as silhouette from widths")
def e22(spark, sf_dir):
    return cluster.mean_silhouette(clustered(spark, sf_dir)).select(F.round("silhouette", 6).alias("silhouette"))


@query("e22_silhouette_rows", f"with {SILHOUETTE.strip()} select vec_id, round(width, 6) as silhouette from widths")
def e22_rows(spark, sf_dir):
    return cluster.silhouette_rows(clustered(spark, sf_dir)).select("vec_id", F.round("silhouette", 6).alias("silhouette"))


@query("e23_dashboard", S.with_(S.HISTORY, f"""
 select count(*) as total_checks, count_if({S.SHOWN} = 'Safe')::bigint as lower_predicted_risk,
 count_if({S.SHOWN} = 'Dangerous')::bigint as potential_phishing from history"""))
def e23(spark, sf_dir):
    return history.dashboard(I.history(spark, sf_dir))


@query("e24_domain_groups", S.with_(GROUPED, "select split, count(distinct domain_group) as domain_groups from grouped group by split"))
def e24(spark, sf_dir):
    return split.statistics(labelled_groups(spark, sf_dir)).select("split", "domain_groups")


@query("e25_diagnostics", S.with_(S.BOTH, S.parse(), f"""
 select count(*) as rows, count_if(host = '' or {S._PARSE_ERROR})::bigint as unusable,
 count_if(u = '')::bigint as empty_urls from parsed"""))
def e25(spark, sf_dir):
    both = I.view(spark, sf_dir, f"{I.ALL_URLS} union select url from ({I.EDGE_V}) e")
    return features.with_features(both).agg(
        F.count("*").alias("rows"), F.count_if(~features.finite()).alias("unusable"),
        F.count_if(urls.strip(F.col("url")) == "").alias("empty_urls"))


# --- F. windows, ranking, samples ---------------------------------------------

@query("f01_split_row_number", S.with_(GROUPED, """
 select row_number, split, row_number() over (partition by split order by row_number) as split_row_number from grouped"""))
def f01(spark, sf_dir):
    return split.with_split_row_number(labelled_groups(spark, sf_dir)).select(
        "row_number", "split", "split_row_number")


@query("f01_split_row_number_any_key", S.with_(GROUPED, """
 select url, row_number, split, row_number() over (partition by split order by url, row_number) as n from grouped"""))
def f01_any(spark, sf_dir):
    rows = labelled_groups(spark, sf_dir).select("url", "row_number", "split")
    return ordered.number_rows(rows, ["url", "row_number"], "n", within=["split"])


@query("f02_output_row_number", S.with_(S.prepared(), """
 select source_row, row_number() over (order by source_row) as row_number from routes where route = 'kept'"""))
def f02(spark, sf_dir):
    kept = routes(spark, sf_dir).where("route = 'kept'").select("source_row")
    return ordered.number_ordinals(kept, "source_row")


@query("f03_duplicates", S.with_(S.prepared(), """
 numbered as (select *, count_if(route = 'kept') over (order by source_row) as n from routes)""", """
 select source_row, url, original_label, original_category, label,
  max(case when route = 'kept' then n end) over (partition by url_key)::bigint as retained_row_number
 from numbered qualify route = 'duplicate'"""))
def f03(spark, sf_dir):
    return outputs(spark, sf_dir, "routes", routes).duplicates


@query("f03_metadata", S.with_(S.prepared(), """
 select row_number() over (order by source_row) as row_number, 'larger' as dataset, source_row, url_key, hostname,
 original_label, categories as original_categories, records as source_record_count from routes where route = 'kept'"""))
def f03_metadata(spark, sf_dir):
    return outputs(spark, sf_dir, "routes", routes).metadata


@query("f03_excluded", S.with_(S.prepared(I.EDGE_V), """
 select source_row, url, original_label, original_category, label,
 case when route = 'conflict' then 'conflicting_binary_labels' else reason end as reason
 from routes where route in ('invalid', 'conflict')"""))
def f03_excluded(spark, sf_dir):
    return outputs(spark, sf_dir, "edge_routes", edge_routes).excluded


@query("f04_top_features", S.with_(PROFILE, """
 select cluster, feature, rank, round(d, 6) as standardized_difference from ranked where rank <= 3"""))
def f04(spark, sf_dir):
    return cluster.top_features(profile_rows(spark, sf_dir)).select(
        "cluster", "feature", "rank", F.round("standardized_difference", 6).alias("standardized_difference"))


@query("f05_central_examples", S.with_(GROUPED, """
 one as (select *, abs(length(url) - 40) as distance, row_number() over (partition by label, domain_group
  order by abs(length(url) - 40), row_number) as r from grouped),
 best as (select *, row_number() over (partition by label order by distance, row_number) as example_rank from one where r = 1)""", """
 select label as cluster, example_rank, row_number, domain_group, distance::double as distance_to_centroid
 from best where example_rank <= 3"""))
def f05(spark, sf_dir):
    rows = labelled_groups(spark, sf_dir).withColumns({
        "cluster": F.col("label"), "distance_to_centroid": F.abs(F.length("url") - 40).cast("double")})
    return cluster.representatives(rows, "row_number").select(
        "cluster", "example_rank", "row_number", "domain_group", "distance_to_centroid")


SCORED_GROUPS = GROUPED + """,
scored as (select *, case when (row_number * 7919) % 100 >= 50 then 0.75 else 0.25 end as probability,
 sha256(concat('42|', row_number)) as h from grouped),
outcomes as (select *, case when label = 0 and probability < 0.5 then 'TN' when label = 0 then 'FP'
 when probability < 0.5 then 'FN' else 'TP' end as outcome from scored)"""


def scored_groups(spark, sf_dir):
    high = F.pmod(F.col("row_number") * 7919, F.lit(100)) >= 50
    return labelled_groups(spark, sf_dir).withColumn("probability", F.when(high, 0.75).otherwise(0.25))


@query("f06_error_sample", S.with_(SCORED_GROUPS, """
 one as (select *, row_number() over (partition by outcome, domain_group order by h, row_number) as r
  from outcomes where outcome in ('FP', 'FN')),
 few as (select *, row_number() over (partition by outcome order by h, row_number) as n from one where r = 1)""", """
 select row_number, url, domain_group, outcome from few where n <= 3"""))
def f06(spark, sf_dir):
    return sampling.error_sample(scored_groups(spark, sf_dir), "row_number").select(
        "row_number", "url", "domain_group", "outcome")


@query("f07_outcome_sample", S.with_(SCORED_GROUPS, """
 few as (select *, row_number() over (partition by outcome order by h, row_number) as n from outcomes)""", """
 select row_number, url, outcome from few where n <= 3"""))
def f07(spark, sf_dir):
    return sampling.outcome_sample(scored_groups(spark, sf_dir), "row_number").select(
        "row_number", "url", "outcome")


@query("f08_fixed_sample", S.with_(GROUPED, """
 select row_number, url from grouped order by sha256(concat('42|', row_number)), row_number limit 2000"""))
def f08(spark, sf_dir):
    rows = labelled_groups(spark, sf_dir).select("row_number", "url")
    return sampling.fixed_sample(rows, "row_number", 2000)


@query("f10_best_model", S.with_(METRICS_SQL, """
 ranked as (select *, row_number() over (partition by uses_https order by f1 desc, tp / (tp + fn) desc, model) as r from f1s)""", """
 select uses_https, model as selected from ranked where r = 1"""))
def f10(spark, sf_dir):
    full = metrics.binary_metrics(I.scored(spark, sf_dir), by=["uses_https", "model"])
    return metrics.best_model(full, ["uses_https"])


# Means of whole millionths: sums of integers, so that no order of rows changes a last digit.
K_TABLE = """select user_id as k, sum(cast(round(value * 1000000) as bigint))::bigint::double / count(*)::double / 1000000
 as silhouette_estimate from events group by user_id"""


@query("f11_best_k", f"select k, silhouette_estimate from ({K_TABLE}) t order by silhouette_estimate desc, k limit 1")
def f11(spark, sf_dir):
    total = F.sum(F.round(F.col("value") * 1000000).cast("bigint")).cast("double")
    return cluster.choose_k(I.table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("k")).agg(
        (total / F.count("*").cast("double") / 1000000).alias("silhouette_estimate")))


@query("f13_recent", S.with_(S.HISTORY, "select id, url from history order by id desc limit 10"))
def f13(spark, sf_dir):
    return history.recent(I.history(spark, sf_dir)).select("id", "url")


@query("f13_retained", S.with_(S.HISTORY, "select id, url from history order by id desc limit 100"))
def f13_retained(spark, sf_dir):
    return history.retained(I.history(spark, sf_dir)).select("id", "url")


@query("f14_check_numbers", S.with_(S.HISTORY, """
 select id, row_number() over (order by ts, id) as check_number, (select max(id) + 1 from history) as next_id from history"""))
def f14(spark, sf_dir):
    rows = I.history(spark, sf_dir).select("id", "ts")
    upcoming = history.next_id(rows).first()["next_id"]
    return history.check_numbers(rows).select("id", "check_number", F.lit(upcoming).alias("next_id"))


@query("f15_cumulative", S.with_(S.SCORED, S.RANKED, """
 select model, p as score, cum_tp::bigint as cum_tp, cum_fp::bigint as cum_fp from cums"""))
def f15(spark, sf_dir):
    return metrics.curve(I.scored(spark, sf_dir), ["model"]).select("model", "score", "cum_tp", "cum_fp")


# --- end to end ---------------------------------------------------------------

@query("x01_flagship", S.with_(S.PAGES, S.featured(), S.grouped("feats"), """
 select split, uses_https, count(*) as rows, count(distinct domain_group) as domain_groups,
 round(avg(entropy), 6) as mean_entropy from grouped group by split, uses_https"""))
def x01(spark, sf_dir):
    rows = features.with_features(I.pages(spark, sf_dir)).select("url", "uses_https", "entropy")
    groups = split.assign(rows, rules=I.RULES).groupBy("split", "uses_https", "domain_group").agg(
        F.count("*").alias("n"), F.sum("entropy").alias("e"))
    return groups.groupBy("split", "uses_https").agg(
        F.sum("n").alias("rows"), F.count("*").alias("domain_groups"),
        F.round(F.sum("e") / F.sum("n"), 6).alias("mean_entropy"))


@query("x02_history_windows", S.with_(S.HISTORY, f"""
 select strftime(to_timestamp(floor(epoch(ts) / 300) * 300), '%Y-%m-%d %H:%M:%S') as window_start, {S.SHOWN} as shown,
 count(*) as checks from history group by 1, 2"""))
def x02(spark, sf_dir):
    rows = history.windowed_totals(I.history(spark, sf_dir))
    return rows.withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm:ss"))
