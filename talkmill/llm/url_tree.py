"""URL filter by a path-template tree, in DataFrame operations only.

Longest-rule verdicts come first. For the rest, each host's paths form a tree: at
each level, segments that vary (numbers, hex, or many distinct values) become a
wildcard, sibling branches whose labelled block rates do not differ significantly
from the other branches are merged, and a template is rejected if its smoothed
labelled purity is high.

Labels are given by a column, or are made of the URL: a host with a cue word is
labelled as blocked, whatever the rules say of it, and other pages that a rule
decides have its verdict. Pages of neither kind have no label and get what the
template that they share with labelled ones gets.

The tree is built on one row per distinct (host, shape), not on the pages, and
levels are joined on (host, prefix), so a hot host is split by its prefixes and
AQE splits what is left. Paths of any depth are told apart: a level goes on with the
templates that still hold several shapes and longer ones.

Defined cases: a null URL or one without '://' has host and path '' and no rule;
repeated rows count again; extra columns are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

#: Fixed by the contract.
RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"))
#: Words of a host name that label its pages as blocked where no labels are given.
CUES = ("adult", "ads", "bets", "casino", "loans", "pills", "porn", "track", "viagra")
#: Levels in the SQL that the query is held against; the tables' paths are no deeper.
SQL_LEVELS = 8
#: A level with this many distinct segments, and more than half as many as rows, is variable.
VARIABLE_MIN = 8
#: Two-sided 5 % limit of the test that merges branches.
Z = 1.96
#: Prior weight in rows, rows with a label that a verdict needs, and the purity that rejects.
WEIGHT, SUPPORT, PURITY = 2.0, 5, 0.8


def parts(url: Column) -> tuple[Column, Column]:
    """(host, path) of a URL; '' for both without '://'."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    raw = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(raw) + 1), r"^[^?#]*", 0)
    return F.translate(raw, common.UPPER, common.LOWER), path


def longest_rule(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits as struct(verdict, rule), null without one."""
    out = F.lit(None).cast("struct<verdict:string,rule:string>")
    for verdict, rule in sorted(rules, key=lambda r: len(r[1])):
        at = rule.index("/")
        name, start = rule[:at], rule[at:]
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(start)
        out = F.when(fits, F.struct(F.lit(verdict).alias("verdict"), F.lit(rule).alias("rule"))).otherwise(out)
    return out


def cue_pattern(cues=CUES) -> str:
    return f"(^|[.-])({'|'.join(cues)})([.-]|$)"


def own_label(host: Column, verdict: Column, cues=CUES) -> Column:
    """1 for a host with a cue word, else 1 or 0 by a rule's verdict, else null."""
    return F.when(host.rlike(cue_pattern(cues)), 1).when(verdict == "block", 1).when(verdict == "allow", 0)


def shapes(path: Column) -> Column:
    """The path's segments with numbers and hex generalised."""
    segments = F.filter(F.split(path, "/"), lambda x: x != "")
    return F.transform(segments, lambda x: F.regexp_replace(F.regexp_replace(x, r"^[0-9a-fA-F]{16,}", "{h}"), r"^[0-9]+", "{n}"))


def templates(labelled: DataFrame) -> DataFrame:
    """(host, shape, template, n, lab, blk) of each distinct shape; labelled has host, shape, label (1 block, 0 allow, null)."""
    tree = labelled.groupBy("host", "shape").agg(F.count("*").alias("n"), F.count("label").alias("lab"), F.coalesce(F.sum("label"), F.lit(0)).cast("long").alias("blk"))
    tree = common.saved(tree).withColumn("template", F.lit(""))
    done: list[DataFrame] = []
    level = 0
    while True:
        tree = tree.withColumn("seg", F.coalesce(F.get("shape", F.lit(level)), F.lit("")))
        children = tree.groupBy("host", "template", "seg").agg(*[F.sum(c).alias(f"c_{c}") for c in ("n", "lab", "blk")])
        nodes = children.groupBy("host", "template").agg(F.count("*").alias("kinds"), *[F.sum(f"c_{c}").alias(f"p_{c}") for c in ("n", "lab", "blk")])
        tree = tree.join(children, ["host", "template", "seg"]).join(nodes, ["host", "template"])
        tree = tree.withColumn("template", F.concat("template", F.lit("/"), branch())).select("host", "shape", "template", "n", "lab", "blk")
        tree = common.saved(tree)  # each level reads the last one twice
        level += 1
        # a template with one shape, or with none that goes deeper, is whole; those of other levels have another number of '/'
        below = tree.groupBy("host", "template").agg(F.count("*").alias("k"), F.max(F.size("shape")).alias("deepest")).filter((F.col("k") > 1) & (F.col("deepest") > level))
        below = common.saved(below.select("host", "template"))
        n = below.count()
        if not n:
            done.append(tree)
            break
        done.append(common.join_small(tree, below, ["host", "template"], "left_anti", n))
        tree = common.saved(common.join_small(tree, below, ["host", "template"], "left_semi", n))
    found = done[0]
    for one in done[1:]:
        found = found.unionByName(one)
    return common.saved(found) if len(done) > 1 else found


def branch() -> Column:
    """What a segment is called in its template: '*' if variable, '~' if merged with its siblings, else itself."""
    rate = lambda blk, lab: F.try_divide(blk.cast("double"), lab.cast("double"))
    own, all_ = rate(F.col("c_blk"), F.col("c_lab")), rate(F.col("p_blk"), F.col("p_lab"))
    rest_lab = F.col("p_lab") - F.col("c_lab")
    others = rate(F.col("p_blk") - F.col("c_blk"), rest_lab)
    variable = (F.col("kinds") >= VARIABLE_MIN) & (2 * F.col("kinds") > F.col("p_n"))
    one = F.lit(1.0)
    error = F.sqrt(all_ * (1 - all_) * (F.try_divide(one, F.col("c_lab").cast("double")) + F.try_divide(one, rest_lab.cast("double"))))
    alike = (F.col("kinds") > 1) & (F.abs(own - others) <= Z * error)
    return F.when(F.col("seg") == "", F.lit("")).when(variable, F.lit("*")).when(alike, F.lit("~")).otherwise(F.col("seg"))


def rejected(tree: DataFrame, prior: float, weight: float = WEIGHT, support: int = SUPPORT, purity: float = PURITY) -> DataFrame:
    """(host, shape, template, share) of the shapes whose template is rejected."""
    stats = tree.groupBy("host", "template").agg(F.sum("lab").alias("t_lab"), F.sum("blk").alias("t_blk"))
    stats = stats.withColumn("share", (F.col("t_blk") + prior * weight) / (F.col("t_lab") + weight)).filter((F.col("t_lab") >= support) & (F.col("share") >= purity))
    return tree.join(stats, ["host", "template"]).select("host", "shape", "template", "share")


def judge(pages: DataFrame, page_id: str = "page_id", url: str = "url", label: Column | None = None, rules=RULES, cues=CUES) -> DataFrame:
    """(page_id, host, path, rule, verdict, template_rejected) of each page.

    label: 1 block, 0 allow, null unknown; by default own_label().
    """
    host, path = parts(F.col(url).cast("string"))
    seen = pages.select(F.col(page_id).cast("long").alias("page_id"), host.alias("host"), path.alias("path"), *([label.cast("int").alias("label")] if label is not None else []))
    seen = seen.withColumn("hit", longest_rule(F.col("host"), F.col("path"), rules)).withColumn("shape", shapes(F.col("path")))
    if label is None:
        seen = seen.withColumn("label", own_label(F.col("host"), F.col("hit.verdict"), cues))
    tree = templates(seen.select("host", "shape", "label"))
    all_rows = tree.agg(F.sum("blk"), F.sum("lab")).first()
    prior = all_rows[0] / all_rows[1] if all_rows[1] else 0.5
    bad = common.saved(rejected(tree, prior).select("host", "shape", F.lit(True).alias("bad")))
    out = common.join_small(seen, bad, ["host", "shape"], "left")
    return out.select("page_id", "host", "path", F.col("hit.rule").alias("rule"), F.coalesce("hit.verdict", F.when(F.col("bad"), "block").otherwise("allow")).alias("verdict"), F.coalesce("bad", F.lit(False)).alias("template_rejected"))


def oracle(rules=RULES) -> str:
    fit = "\n".join(
        f"      WHEN (host = '{r[: r.index('/')]}' OR ends_with(host, '.{r[: r.index('/')]}')) AND starts_with(path, '{r[r.index('/') :]}') THEN '{{0}}'".replace("{0}", r)
        for _, r in sorted(rules, key=lambda r: -len(r[1]))
    )
    verdicts = " ".join(f"WHEN '{r}' THEN '{v}'" for v, r in rules)
    levels, last = [], "shaped"
    for i in range(SQL_LEVELS):
        levels.append(f"""
c{i} AS (SELECT host, template, coalesce(shape[{i + 1}], '') AS seg, sum(n) AS c_n, sum(lab) AS c_lab, sum(blk) AS c_blk FROM {last} GROUP BY ALL),
p{i} AS (SELECT host, template, count(*) AS kinds, sum(c_n) AS p_n, sum(c_lab) AS p_lab, sum(c_blk) AS p_blk FROM c{i} GROUP BY ALL),
t{i} AS (
  SELECT t.host, t.shape, t.n, t.lab, t.blk, t.template || '/' || CASE
      WHEN c.seg = '' THEN ''
      WHEN kinds >= {VARIABLE_MIN} AND 2 * kinds > p_n THEN '*'
      WHEN kinds > 1 AND c_lab > 0 AND p_lab > c_lab AND abs(c_blk / nullif(c_lab, 0) - (p_blk - c_blk) / nullif(p_lab - c_lab, 0))
           <= {Z} * sqrt((p_blk / nullif(p_lab, 0)) * (1 - p_blk / nullif(p_lab, 0)) * (1 / nullif(c_lab, 0) + 1 / nullif(p_lab - c_lab, 0))) THEN '~'
      ELSE c.seg END AS template
  FROM {last} t JOIN c{i} c ON c.host = t.host AND c.template = t.template AND c.seg = coalesce(t.shape[{i + 1}], '')
  JOIN p{i} p ON p.host = t.host AND p.template = t.template)""")
        last = f"t{i}"
    return f"""
WITH cut AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
hosts AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM cut),
split AS (
  SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM hosts),
ruled AS (
  SELECT *, CASE
{fit}
      END AS rule FROM split),
seen AS (
  SELECT *, CASE rule {verdicts} END AS by_rule, list_filter(string_split(path, '/'), lambda x: x <> '') AS segs FROM ruled),
shaped0 AS (
  SELECT *, list_transform(segs, lambda x: regexp_replace(regexp_replace(x, '^[0-9a-fA-F]{{16,}}', '{{h}}'), '^[0-9]+', '{{n}}')) AS shape,
         CASE WHEN regexp_matches(host, '{cue_pattern()}') OR by_rule = 'block' THEN 1 WHEN by_rule = 'allow' THEN 0 END AS label FROM seen),
shaped AS (
  SELECT host, shape, count(*) AS n, count(label) AS lab, count(*) FILTER (label = 1) AS blk, '' AS template
  FROM shaped0 GROUP BY host, shape),{",".join(levels)},
prior AS (SELECT CASE WHEN sum(lab) > 0 THEN sum(blk) / sum(lab) ELSE 0.5 END AS share FROM {last}),
stats AS (
  SELECT host, template FROM {last} GROUP BY ALL
  HAVING sum(lab) >= {SUPPORT} AND (sum(blk) + (SELECT share FROM prior) * {WEIGHT}) / (sum(lab) + {WEIGHT}) >= {PURITY}),
bad AS (SELECT t.host, t.shape FROM {last} t JOIN stats USING (host, template))
SELECT page_id, s.host, path, rule, coalesce(by_rule, CASE WHEN bad.host IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
FROM shaped0 s LEFT JOIN bad ON bad.host = s.host AND bad.shape = s.shape
"""
