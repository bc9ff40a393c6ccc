"""URL filters: rules indexed by their rarest literal token."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import query, read

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TOKEN = r"[\p{L}\p{N}_-]+"


@dataclass(frozen=True)
class Rule:
    """``text`` is a host with a path prefix (``example.org/en/``), or a pattern.

    A pattern starts with ``||`` (a host label starts here) or with ``*``; ``*`` stands
    for any characters and ``^`` for a separator or the end. Both kinds are matched
    against the host (lower case) followed by the path.
    """

    text: str
    action: str

    @property
    def is_pattern(self) -> bool:
        return self.text.startswith(("||", "*"))

    @property
    def regex(self) -> str:
        if not self.is_pattern:
            return rf"^([^/]*\.)?{re.escape(self.text)}"
        body, start = (self.text[2:], r"^([^/]*\.)?") if self.text.startswith("||") else (self.text, "")
        parts = {"*": ".*", "^": r"([^\p{L}\p{N}_-]|$)"}
        return "(?s)" + start + "".join(parts.get(c) or re.escape(c) for c in body)

    @property
    def tokens(self) -> list[str]:
        """Literal words that are whole words of every URL the rule fits."""
        text = self.text.removeprefix("||")
        found = []
        for m in re.finditer(r"[^\W]+(?:[-\w]*)|-[-\w]*", text):
            whole_start = m.start() == 0 or text[m.start() - 1] != "*"
            whole_end = m.end() < len(text) and text[m.end()] != "*"
            if whole_start and whole_end:
                found.append(m.group().lower())
        return found


def judge(
    pages: DataFrame,
    rules: list[Rule],
    *,
    id_col: str = "page_id",
    url_col: str = "url",
    default: str = "allow",
) -> DataFrame:
    """One row for each page: id, host, path, rule, verdict, pattern.

    The longest host/path rule that fits decides (of equally long ones a blocking
    one, then the first text); ``rule`` is its text. Without one, a fitting pattern
    decides: an allowing one before blocking ones; ``pattern`` is its text. Else the
    default holds. A null URL, or one without ``://``, has an empty host and path,
    which no host rule fits. Repeated rows stay, an empty table gives no rows, other
    columns are ignored.

    Tokens of all distinct URLs are counted for the words that rules contain; each
    rule is filed under its rarest one. A URL's tokens then fetch candidate rules in
    a join, and only those run their regular expression. Rules without a whole
    literal word are fetched by every URL. The rule table is a literal relation, so
    Spark broadcasts it only while its size is below the broadcast threshold.
    """
    spark = pages.sparkSession
    url = F.coalesce(F.col(url_col), F.lit(""))
    rest = F.when(F.locate("://", url) > 0, F.substr(url, F.locate("://", url) + 3)).otherwise(F.lit(""))
    host = F.regexp_extract(F.col("rest"), r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(F.col("rest"), F.length("host") + 1), r"^[^?#]*", 0)
    split = pages.select(F.col(id_col), rest.alias("rest")).withColumn("host", host).withColumn("path", path)
    split = split.select(F.col(id_col), F.translate("host", UPPER, LOWER).alias("host"), "path")
    split = split.withColumn("subject", F.concat("host", "path"))

    listed = spark.createDataFrame(
        [(r.text, r.action, r.is_pattern, r.regex, sorted(set(r.tokens))) for r in rules],
        "rule string, action string, is_pattern boolean, regex string, tokens array<string>",
    )
    subjects = split.select("subject").distinct()
    words = F.array_distinct(F.regexp_extract_all(F.lower("subject"), F.lit(f"({TOKEN})"), 1))
    asked = subjects.select("subject", F.explode(F.concat(words, F.array(F.lit("")))).alias("token"))
    known = listed.select(F.explode("tokens").alias("token")).distinct()
    often = asked.join(known, "token", "left_semi").groupBy("token").agg(F.count("*").alias("n"))
    filed = listed.select("*", F.explode_outer("tokens").alias("token")).join(often, "token", "left")
    rarest = F.min_by("token", F.struct(F.coalesce("n", F.lit(0)), -F.length("token"), "token"))
    index = filed.groupBy("rule", "action", "is_pattern", "regex").agg(F.coalesce(rarest, F.lit("")).alias("token"))

    fits = asked.join(index, "token").where("subject rlike regex")
    better = F.struct(~F.col("is_pattern"), F.when(~F.col("is_pattern"), F.length("rule")).otherwise(0),
                      F.when(F.col("is_pattern"), F.col("action") == "allow").otherwise(F.col("action") == "block"))
    best = fits.groupBy("subject").agg(F.max(better).alias("best"), F.min_by(F.struct("rule", "action", "is_pattern"), F.struct(
        ~better["col1"], -better["col2"], ~better["col3"], "rule")).alias("won")).select("subject", "won.*")
    return split.join(best, "subject", "left").select(
        id_col,
        "host",
        "path",
        F.when(~F.col("is_pattern"), F.col("rule")).alias("rule"),
        F.coalesce("action", F.lit(default)).alias("verdict"),
        F.when(F.col("is_pattern"), F.col("rule")).alias("pattern"),
    )


RULES = [
    Rule("org/", "allow"),
    Rule("example.org/es/", "block"),
    Rule("example.org/en/1", "block"),
    Rule("com/fr/", "allow"),
    Rule("com/de/", "block"),
    Rule("||ads-track^", "block"),
    Rule("||adult-x^", "block"),
    Rule("||casino-win^", "block"),
    Rule("||cheap-pills^", "block"),
    Rule("||free-bets^", "block"),
    Rule("||spam-farm^", "block"),
]

OP2_SQL = r"""
WITH cut AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
  SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS raw,
         regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path FROM cut
), named AS (
  SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, path FROM parts
), ruled AS (
  SELECT *, CASE
      WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/en/1') THEN 'example.org/en/1'
      WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/es/') THEN 'example.org/es/'
      WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/fr/') THEN 'com/fr/'
      WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/de/') THEN 'com/de/'
      WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/') THEN 'org/' END AS rule
  FROM named
), spam AS (
  SELECT *, CASE WHEN rule IS NOT NULL THEN NULL
      WHEN regexp_matches(host || path, '^([^/]*\.)?ads-track([^\pL\pN_-]|$)') THEN '||ads-track^'
      WHEN regexp_matches(host || path, '^([^/]*\.)?adult-x([^\pL\pN_-]|$)') THEN '||adult-x^'
      WHEN regexp_matches(host || path, '^([^/]*\.)?casino-win([^\pL\pN_-]|$)') THEN '||casino-win^'
      WHEN regexp_matches(host || path, '^([^/]*\.)?cheap-pills([^\pL\pN_-]|$)') THEN '||cheap-pills^'
      WHEN regexp_matches(host || path, '^([^/]*\.)?free-bets([^\pL\pN_-]|$)') THEN '||free-bets^'
      WHEN regexp_matches(host || path, '^([^/]*\.)?spam-farm([^\pL\pN_-]|$)') THEN '||spam-farm^' END AS pattern
  FROM ruled
)
SELECT page_id, host, path, rule, pattern,
       CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL OR pattern IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict
FROM spam
"""


@query("op2_url_filters", OP2_SQL)
def op2(spark, folder):
    return judge(read(spark, folder, "pages"), RULES)
