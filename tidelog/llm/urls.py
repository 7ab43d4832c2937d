"""URL filter by path templates (operator 6).

Fixed rules decide first. Other urls are judged by the template of their path
in their host's tree of paths. Digits and the branches of nodes with many
become wildcards, and so do sibling branches whose labelled shares do not
differ significantly, which merges their subtrees. A node's bad share is
smoothed towards the node above, up to the host and to all labels, and a
template is rejected when it reaches a limit found on the labelled urls. The
tree is built from distinct path shapes with counts, so its size follows the
shapes, not the urls. All of it is DataFrame operations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm.common import ascii_lower, stored

URL_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
#: What a path may end in without being another template.
ENDING = r"(\.[A-Za-z]{2,5})?/*$"


def parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty without ``://``."""
    text = F.coalesce(url.cast("string"), F.lit(""))
    return (
        ascii_lower(F.regexp_extract(text, URL_PARTS, 1)),
        F.regexp_extract(text, URL_PARTS, 2),
    )


def fitting_rule(rules: dict[str, str], host: Column, path: Column) -> Column:
    """The longest rule whose host is the url's or a parent domain of it and
    whose path starts the url's path; null if none fits. One condition per
    rule, so for short lists."""
    fits = []
    for rule in sorted(rules, key=lambda r: (-len(r), r)):
        domain, slash, rest = rule.partition("/")
        inside = (host == domain) | host.endswith(f".{domain}")
        fits.append(F.when(inside & path.startswith(slash + rest), F.lit(rule)))
    return F.coalesce(*fits, F.lit(None).cast("string"))


def _nodes(steps: DataFrame) -> DataFrame:
    """``steps`` with the ``parent`` of each: a hash of the segments before it,
    formed along a window over one path, so in time linear in its length."""
    before = Window.partitionBy("host", "shape").orderBy("depth")
    marks = F.bit_xor(F.xxhash64("depth", "segment")).over(
        before.rowsBetween(Window.unboundedPreceding, -1)
    )
    return steps.withColumn("parent", F.coalesce(marks, F.lit(0)))


def _children(nodes: DataFrame) -> DataFrame:
    """Every branch of every node with its labelled counts."""
    return nodes.groupBy("host", "depth", "parent", "segment").agg(
        F.sum("labelled").alias("n"), F.sum("bad").alias("n_bad")
    )


def _general(children: DataFrame, max_children: int, max_z: float) -> DataFrame:
    """The branches that become a wildcard: all of a node with more than
    ``max_children``, and labelled ones whose bad share differs from that of
    their labelled siblings by under ``max_z`` standard errors."""
    families = children.groupBy("host", "depth", "parent").agg(
        F.count("*").alias("siblings"),
        F.sum("n").alias("all_n"),
        F.sum("n_bad").alias("all_bad"),
    )
    n, others = F.col("n"), F.nullif(F.col("all_n") - F.col("n"), F.lit(0))
    rate = F.try_divide("all_bad", "all_n")
    gap = F.col("n_bad") / n - (F.col("all_bad") - F.col("n_bad")) / others
    alike = gap * gap <= max_z * max_z * rate * (1 - rate) * (1 / n + 1 / others)
    return (
        children.withColumn("n", F.nullif("n", F.lit(0)))
        .join(families, ["host", "depth", "parent"])
        .filter(F.col("segment") != "*")
        .filter((F.col("siblings") > max_children) | F.coalesce(alike, F.lit(False)))
        .select("host", "depth", "parent", "segment", F.lit(True).alias("general"))
    )


def _tree(shapes: DataFrame, max_children: int, max_z: float) -> DataFrame:
    """The paths' segments after all wildcards: host, shape, depth, segment,
    labelled and bad.

    Branches that become wildcards share their subtrees, whose branches may
    then be wide or alike in turn; so nodes are looked at again until nothing
    changes. Each round is a written table; rounds are as many as wildcards
    that depend on one another, at most the segments of a path.
    """
    segments = F.posexplode(F.split("shape", "/")).alias("depth", "segment")
    steps = stored(shapes.select("host", "shape", "labelled", "bad", segments), "url-steps")
    while True:
        nodes = _nodes(steps)
        general = stored(_general(_children(nodes), max_children, max_z), "url-wildcards")
        if general.isEmpty():
            return steps
        segment = F.when(F.col("general"), F.lit("*")).otherwise(F.col("segment"))
        steps = stored(
            nodes.join(general, ["host", "depth", "parent", "segment"], "left").select(
                "host", "shape", "labelled", "bad", "depth", segment.alias("segment")
            ),
            "url-steps",
        )


def _share(path: Column, prior: Column, smoothing: float, own: int | None = None) -> Column:
    """The bad share of a path's last node, each node's smoothed towards the
    one above it; a node with the labels of the one above adds nothing.
    ``own`` takes a label of that value out of every node."""
    less, less_bad = (0, 0) if own is None else (1, own)

    def down(above: Column, node: Column) -> Column:
        n, bad = node["n"] - less, node["n_bad"] - less_bad
        share = F.try_divide(bad + smoothing * above["share"], n + smoothing)
        return F.struct(
            F.when(n == above["n"], above["share"]).otherwise(share).alias("share"),
            n.cast("long").alias("n"),
        )

    start = F.struct(prior.cast("double").alias("share"), F.lit(-1).cast("long").alias("n"))
    return F.aggregate(path, start, down)["share"]


def _limit(judged: DataFrame, min_purity: float) -> DataFrame:
    """One row: the share from which on labelled urls, judged without their own
    label, have most bad ones beyond ``min_purity`` of all; null if no limit
    has any beyond it.

    Shares are rounded down to thousandths, so the window has 1,001 rows at most.
    """
    labelled = judged.select(
        F.explode(
            F.array(
                F.struct(
                    F.col("share_if_bad").alias("s"), F.col("bad").alias("n"), F.lit(1).alias("y")
                ),
                F.struct(
                    F.col("share_if_good").alias("s"),
                    (F.col("labelled") - F.col("bad")).alias("n"),
                    F.lit(0).alias("y"),
                ),
            )
        ).alias("l")
    ).filter("l.n > 0")
    steps = labelled.groupBy((F.floor(F.col("l.s") * 1000) / 1000).alias("share")).agg(
        F.sum("l.n").alias("n"), F.sum(F.col("l.n") * F.col("l.y")).alias("n_bad")
    )
    above = Window.orderBy(F.desc("share"))
    gain = F.sum("n_bad").over(above) - min_purity * F.sum("n").over(above)
    return (
        steps.withColumn("gain", gain)
        .filter("gain > 0")
        .agg(F.max_by("share", F.struct("gain", "share")).alias("limit"))
    )


def judge(
    pages: DataFrame,
    labels: DataFrame,
    rules: dict[str, str],
    id_col: str = "page_id",
    url_col: str = "url",
    max_children: int = 20,
    max_z: float = 2.0,
    smoothing: float = 5.0,
    min_purity: float = 0.5,
) -> DataFrame:
    """One row per row of ``pages``: page_id, host, path, rule, verdict,
    template, bad_share and bad_limit.

    ``labels`` has ``id`` (of a page) and ``bad`` (0 or 1, null: not
    labelled); an id given twice is bad if one of its rows is. ``rules`` maps
    rules such as ``net/`` to ``allow`` or ``block``. Without a rule a url is
    blocked if the bad share of its template is ``bad_limit`` or more. A share
    is smoothed by ``smoothing`` rows towards that of the node above, the
    host's towards that of all labels. The limit is the one that catches most
    bad urls beyond a share of ``min_purity`` among the labelled ones, each
    judged without its own label; if none catches any, or without labels,
    nothing is blocked but by rules. Null and malformed urls share the empty host and path. A
    null id has no label. Repeated rows give repeated results; an empty table
    none. Only the two named columns are read, so others may have any name.
    """
    host, path = parts(F.col(url_col))
    urls = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    shape = F.regexp_replace(F.regexp_replace("path", "[0-9]+", "*"), ENDING, "")
    urls = urls.withColumn("shape", shape)
    marks = labels.groupBy("id").agg(F.max("bad").alias("bad")).filter("bad is not null")
    shapes = stored(
        urls.join(marks, urls.page_id == marks.id, "left")
        .groupBy("host", "shape")
        .agg(F.count("bad").alias("labelled"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad")),
        "url-shapes",
    )
    nodes = _nodes(_tree(shapes, max_children, max_z))
    hosts = shapes.groupBy("host").agg(F.sum("labelled").alias("n"), F.sum("bad").alias("n_bad"))
    prior = shapes.agg(
        F.coalesce(F.try_divide(F.sum("bad"), F.sum("labelled")), F.lit(0.0)).alias("prior")
    )
    node = F.struct("depth", "segment", "n", "n_bad")
    paths = (
        nodes.join(_children(nodes), ["host", "depth", "parent", "segment"])
        .groupBy("host", "shape")
        .agg(F.array_sort(F.collect_list(node)).alias("path"))  # of one path's segments
    )
    top = F.array(F.struct("n", "n_bad"))
    below = F.transform("path", lambda x: F.struct(x["n"].alias("n"), x["n_bad"].alias("n_bad")))
    judged = (
        paths.join(shapes, ["host", "shape"])
        .join(hosts, "host")
        .join(F.broadcast(prior))  # one row
        .withColumn("counts", F.concat(top, below))
        .select(
            "host",
            "shape",
            "labelled",
            "bad",
            F.array_join("path.segment", "/").alias("template"),
            _share(F.col("counts"), F.col("prior"), smoothing).alias("bad_share"),
            _share(F.col("counts"), F.col("prior"), smoothing, own=1).alias("share_if_bad"),
            _share(F.col("counts"), F.col("prior"), smoothing, own=0).alias("share_if_good"),
        )
    )
    judged = stored(judged, "url-templates")
    verdicts = judged.select("host", "shape", "template", "bad_share").join(
        F.broadcast(_limit(judged, min_purity).withColumnRenamed("limit", "bad_limit"))  # one row
    )
    rule = fitting_rule(rules, F.col("host"), F.col("path"))
    by_rule = F.create_map(*[F.lit(x) for pair in rules.items() for x in pair]) if rules else None
    learned = F.when(F.col("bad_share") >= F.col("bad_limit"), F.lit("block")).otherwise(
        F.lit("allow")
    )
    ruled = F.coalesce(by_rule[F.col("rule")], learned) if rules else learned
    return (
        urls.join(verdicts, ["host", "shape"])
        .withColumn("rule", rule)
        .select(
            "page_id", "host", "path", "rule", ruled.alias("verdict"), "template", "bad_share", "bad_limit"
        )
    )
