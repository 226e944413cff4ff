"""Registered queries of this subpackage."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pagelens.session import prepare, table

#: Folder of the public vocabulary files; a parameter of every query that needs one.
TOKENIZERS = os.environ.get("PAGELENS_TOKENIZERS", "/opt/tokenizers")


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages whose family of writer and book lies on more than one side."""
    from pagelens.llm.splits import split_families

    return split_families(table(prepare(spark), sf_dir, "page_records"))


#: Proportions of the splits that p2_split assigns.
PROPORTIONS = {"train": 0.8, "val": 0.1, "test": 0.1}


def p2_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A split for each page that keeps families together."""
    from pagelens.llm.splits import assign_splits

    return assign_splits(table(prepare(spark), sf_dir, "page_records"), PROPORTIONS)


def p2_split_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of each split of p2_split and families that lie in more than one."""
    from pyspark.sql import functions as F

    per = p2_split(spark, sf_dir).groupBy("family", "split").agg(F.count("*").alias("n")).groupBy("family").agg(F.map_from_entries(F.collect_list(F.struct("split", "n"))).alias("n"))
    each = per.select(F.explode("n").alias("split", "pages"), (F.size("n") - 1).alias("torn"))
    return each.groupBy("split").agg(F.sum("pages").alias("pages"), F.sum("torn").cast("bigint").alias("torn"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of training and evaluation pages that are the same or nearly."""
    from pagelens.llm.cross_split import cross_split_pairs

    return cross_split_pairs(table(prepare(spark), sf_dir, "page_records"))


def p3_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlaps of p3_found per split and source."""
    from pagelens.llm.cross_split import overlap_report

    return overlap_report(table(prepare(spark), sf_dir, "page_records"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of regions whose texts look the same but have different characters."""
    from pagelens.llm.confusables import look_alike_pairs, look_digests

    rows = table(prepare(spark), sf_dir, "region_rows")
    return look_alike_pairs(look_digests(rows, "region_key", "text", "exported_at")).toDF("region_a", "region_b")


def p4_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of region texts by kind: of several scripts, of one that could be another, or of one."""
    from pagelens.llm.confusables import token_kinds

    return token_kinds(table(prepare(spark), sf_dir, "region_rows"))


def p6_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of each document by byte_bpe_50k."""
    from pagelens.llm.encode import encode_corpus

    return encode_corpus(table(prepare(spark), sf_dir, "documents"), f"{TOKENIZERS}/byte_bpe_50k.tiktoken")


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with the evaluation items that leaked into them."""
    from pagelens.llm.leakage import leaked_items

    prepare(spark)
    return leaked_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items"))


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with template residue, filler, error pages or script notices."""
    from pagelens.llm.residue import residue_documents

    return residue_documents(table(prepare(spark), sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"p2_found": p2_found, "p2_split": p2_split, "p2_split_totals": p2_split_totals, "p3_found": p3_found, "p3_report": p3_report, "p4_found": p4_found, "p4_tokens": p4_tokens, "p6_ids": p6_ids, "p7_found": p7_found, "p8_found": p8_found}


P2_FOUND_SQL = r"""
WITH RECURSIVE p AS (
  SELECT page_id, CASE WHEN lower(split) IN ('train', 'silver') THEN 1 WHEN lower(split) = 'val' THEN 2 WHEN lower(split) = 'test' THEN 3 END AS side,
    'w:' || nullif(regexp_extract(coalesce(writer_ref, ''), '0*([0-9]+)', 1), '') AS w,
    'b:' || nullif(regexp_extract(lower(url_decode(split_part(coalesce(nullif(file_name, ''), nullif(image.path, ''), nullif(image.src, '')), '/', -1))), '(^|[^\p{L}])nb[^0-9\p{L}]*0*([0-9]+)', 2), '') || ':' || coalesce(nullif(source, ''), 'unknown') AS b
  FROM page_records WHERE page_id IS NOT NULL),
k AS (SELECT page_id, side, coalesce(w, b, 'p:' || page_id) AS key FROM p),
e AS (SELECT DISTINCT w AS x, b AS y FROM p WHERE w IS NOT NULL AND b IS NOT NULL UNION SELECT b, w FROM p WHERE w IS NOT NULL AND b IS NOT NULL),
reach AS (SELECT DISTINCT key AS v, key AS r FROM k UNION SELECT reach.v, e.y FROM reach JOIN e ON reach.r = e.x),
family AS (SELECT v, min(r) AS family FROM reach GROUP BY v),
f AS (SELECT page_id, side, family FROM k JOIN family ON k.key = family.v)
SELECT DISTINCT page_id FROM f WHERE family IN (SELECT family FROM f GROUP BY family HAVING min(side) < max(side))
"""


# Families of one page are frequent enough for totals that are exact; no family may be torn.
P2_TOTALS_SQL = """
WITH n AS (SELECT count(DISTINCT page_id) AS n FROM page_records), held AS (SELECT n, round_even(n * 0.1, 0)::BIGINT AS k FROM n)
SELECT unnest(['train', 'val', 'test']) AS split, unnest([n - 2 * k, k, k]) AS pages, 0::BIGINT AS torn FROM held
"""


# Letters drawn alike, written out: Cyrillic, Greek and other letters to Latin ones, or Greek to Cyrillic ones.
_DRAWN = "асԁеһіјӏорԛѕԝхуүοϲρν" "АВСЕНІӀЈКМОРЅТХҮԜԚ" "ΑΒΕΗΙΚΜΝΟΡΤΧΥΖϹ" "ΓΠΦ"
_AS = "acdehijlopqswxyyocpv" "ABCEHIIJKMOPSTXYWQ" "ABEHIKMNOPTXYZC" "ГПФ"


def _look_sql() -> str:
    """Shapes letter by letter: the same classes as the script sets give, since those depend on the shape only."""
    wide = "".join(map(chr, range(0xFF01, 0xFF5F)))
    plain = "".join(map(chr, range(0x21, 0x7F))).replace("'", "''")
    t = "regexp_replace(text, '[\\x{ad}\\x{34f}\\x{200b}-\\x{200f}\\x{2060}-\\x{2064}\\x{feff}]', '', 'g')"
    t = f"translate({t}, '{wide}', '{plain}')"
    t = f"regexp_replace({t}, '[\\x{{a0}}\\x{{1680}}\\x{{2000}}-\\x{{200a}}\\x{{202f}}\\x{{205f}}\\x{{3000}}\\t]', ' ', 'g')"
    t = f"translate({t}, '{_DRAWN}', '{_AS}')"  # marks stay behind their letters
    t = f"translate(nfc_normalize({t}), 'ёЁїЇ', 'ëËïÏ')"
    return f"trim({t})"


# Tokens by script: several scripts, or one whose letters all have twins in a second one.
P4_TOKENS_SQL = r"""
WITH t AS (SELECT nfc_normalize(regexp_replace(translate(text, 'ＡＢＣＤＥＦＧＨＩＪＫＬＭＮＯＰＱＲＳＴＵＶＷＸＹＺａｂｃｄｅｆｇｈｉｊｋｌｍｎｏｐｑｒｓｔｕｖｗｘｙｚ', 'ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz'), '[\x{ad}\x{34f}\x{200b}-\x{200f}\x{2060}-\x{2064}\x{feff}]', '', 'g')) AS t FROM region_rows WHERE text IS NOT NULL),
w AS (SELECT unnest(regexp_extract_all(t, '[\p{L}\p{No}\p{Nl}][\p{L}\p{M}\p{No}\p{Nl}]*')) AS w FROM t),
k AS (SELECT regexp_replace(translate(w, 'ёЁїЇйЙ', 'еЕіІиИ'), '[^\p{Latin}\p{Cyrillic}\p{Greek}]', '', 'g') AS w FROM w)
SELECT CASE WHEN regexp_matches(w, '\p{Latin}')::INT + regexp_matches(w, '\p{Cyrillic}')::INT + regexp_matches(w, '\p{Greek}')::INT > 1 THEN 'mixed'
  WHEN regexp_full_match(w, '[acdehijlopqsvwxyABCEGHIJKMOPQSTVWXY]+|[acjopvcABCEHIJKMNOPTXYZ]+|[ghnoqsuOSU]+|[ABCDEGHJKLMPRSTVWZ]+|[асԁеһіјӏорԛѕѵԝхуүАВСЕԌНІӀЈКМОРԚЅТѴԜХҮ]+|[соруѵАВСЕНІӀЈКМОРТХҮГПФ]+|[оОЅ]+|[АВСЕԌНЈКМРЅТѴԜ]+|[οϲϳρνΑΒϹΕΗΙͿΚΜϺΝΟΡΤΧΥΖΓΠΦ]+') AND w <> '' THEN 'whole' ELSE 'single' END AS kind, count(*) AS tokens FROM k GROUP BY 1
"""


def _p4_sql() -> str:
    return f"""
WITH last_ AS (SELECT region_key, text FROM region_rows WHERE region_key IS NOT NULL QUALIFY row_number() OVER (PARTITION BY region_key ORDER BY exported_at DESC NULLS LAST) = 1),
looks AS (SELECT region_key, text, {_look_sql()} AS look FROM last_ WHERE text IS NOT NULL)
SELECT least(a.region_key, b.region_key) AS region_a, greatest(a.region_key, b.region_key) AS region_b
FROM looks a JOIN looks b ON a.look = b.look AND a.text < b.text WHERE a.look <> ''
"""


def oracle_sql() -> dict[str, str]:
    return {"p2_found": P2_FOUND_SQL, "p2_split_totals": P2_TOTALS_SQL, "p4_found": _p4_sql(), "p4_tokens": P4_TOKENS_SQL}
