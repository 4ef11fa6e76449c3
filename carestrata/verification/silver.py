"""Cleansing, derivation and reshaping over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carestrata.functions.cleanse import (
    active_flag,
    blank_to,
    display_name,
    keep_state,
    keep_ten_digits,
    open_end,
    rating_category,
    right_closed_bins,
    zip5,
    zip_plus4,
)
from carestrata.functions.hashing import PIPE, row_hash
from carestrata.operators.predicates import has_text
from carestrata.operators.reshape import split_addresses, unpivot_groups
from carestrata.settings import ADDRESS_COLUMNS, MAILING_ADDRESS, PRACTICE_ADDRESS
from carestrata.verification.registry import table, verify


@verify("""
    WITH party AS (
      SELECT 'C' || c_custkey AS party_id, '1' AS kind, split_part(c_name, '#', 1) AS last_name,
             CASE WHEN c_mktsegment <> 'FURNITURE' THEN c_mktsegment END AS first_name,
             CASE WHEN c_acctbal >= 0 THEN split_part(c_name, '#', 2) END AS middle_name,
             c_name AS organisation
      FROM customer
      UNION ALL
      SELECT 'S' || s_suppkey, CASE WHEN s_acctbal >= 0 THEN '2' END, NULL, NULL, NULL, s_name FROM supplier)
    SELECT party_id,
           CASE WHEN kind = '1'
                THEN coalesce(last_name, '') || ', ' || coalesce(first_name, '') || coalesce(' ' || middle_name, '')
                ELSE organisation END AS display_name
    FROM party WHERE party_id IS NOT NULL
""")
def silver_party_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer, supplier = table(spark, sf_dir, "customer"), table(spark, sf_dir, "supplier")
    name = F.split("c_name", "#")
    people = customer.select(
        F.concat(F.lit("C"), "c_custkey").alias("party_id"),
        F.lit("1").alias("kind"),
        name[0].alias("last"),
        F.when(F.col("c_mktsegment") != "FURNITURE", F.col("c_mktsegment")).alias("first"),
        F.when(F.col("c_acctbal") >= 0, name[1]).alias("middle"),
        F.col("c_name").alias("organisation"),
    )
    none = F.lit(None).cast("string")
    firms = supplier.select(
        F.concat(F.lit("S"), "s_suppkey").alias("party_id"),
        F.when(F.col("s_acctbal") >= 0, "2").alias("kind"),
        none.alias("last"),
        none.alias("first"),
        none.alias("middle"),
        F.col("s_name").alias("organisation"),
    )
    shown = display_name(*[F.col(c) for c in ("kind", "last", "first", "middle", "organisation")])
    return people.unionByName(firms).where(F.col("party_id").isNotNull()).select("party_id", shown.alias("display_name"))


_CONTACT_SQL = """
    SELECT c_custkey,
           CASE c_mktsegment
             WHEN 'AUTOMOBILE' THEN lpad(CAST(c_custkey AS VARCHAR), 10, '2')
             WHEN 'BUILDING' THEN '(212) ' || lpad(CAST(c_custkey AS VARCHAR), 7, '5')
             WHEN 'FURNITURE' THEN lpad(CAST(c_custkey AS VARCHAR), 9, '3') || ' ext'
             WHEN 'HOUSEHOLD' THEN '+1 ' || lpad(CAST(c_custkey AS VARCHAR), 10, '4') END AS phone,
           CASE WHEN c_nationkey < 10 THEN 'N' || c_nationkey ELSE 'NATION ' || c_nationkey END AS state,
           CASE WHEN c_nationkey < 8 THEN lpad(CAST(c_custkey AS VARCHAR), 5, '0')
                WHEN c_nationkey < 14 THEN lpad(CAST(c_custkey AS VARCHAR), 5, '0') || '-' || lpad(CAST(c_nationkey AS VARCHAR), 4, '0')
                WHEN c_nationkey < 20 THEN lpad(CAST(c_custkey AS VARCHAR), 9, '7')
                WHEN c_nationkey < 23 THEN lpad(CAST(c_custkey AS VARCHAR), 6, '1') END AS postal
    FROM customer"""


@verify(f"""
    SELECT c_custkey,
           CASE WHEN length(regexp_replace(phone, '[^0-9]', '', 'g')) = 10 THEN phone END AS phone,
           CASE WHEN length(state) = 2 THEN state END AS state,
           substring(postal, 1, 5) AS zip5,
           CASE WHEN length(postal) > 5 THEN substring(postal, 7, 4) END AS plus4,
           CASE WHEN length(regexp_replace(postal, '[^0-9]', '', 'g')) = 9
                THEN substring(regexp_replace(postal, '[^0-9]', '', 'g'), 6, 4) END AS plus4_digits
    FROM ({_CONTACT_SQL})
""")
def silver_contact_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, nation, segment = F.col("c_custkey").cast("string"), F.col("c_nationkey"), F.col("c_mktsegment")
    phone = (
        F.when(segment == "AUTOMOBILE", F.lpad(key, 10, "2"))
        .when(segment == "BUILDING", F.concat(F.lit("(212) "), F.lpad(key, 7, "5")))
        .when(segment == "FURNITURE", F.concat(F.lpad(key, 9, "3"), F.lit(" ext")))
        .when(segment == "HOUSEHOLD", F.concat(F.lit("+1 "), F.lpad(key, 10, "4")))
    )
    state = F.when(nation < 10, F.concat(F.lit("N"), nation)).otherwise(F.concat(F.lit("NATION "), nation))
    plain = F.lpad(key, 5, "0")
    postal = (
        F.when(nation < 8, plain)
        .when(nation < 14, F.concat(plain, F.lit("-"), F.lpad(nation.cast("string"), 4, "0")))
        .when(nation < 20, F.lpad(key, 9, "7"))
        .when(nation < 23, F.lpad(key, 6, "1"))
    )
    raw = table(spark, sf_dir, "customer").select(
        "c_custkey", phone.alias("phone"), state.alias("state"), postal.alias("postal")
    )
    return raw.select(
        "c_custkey",
        keep_ten_digits(F.col("phone")).alias("phone"),
        keep_state(F.col("state")).alias("state"),
        zip5(F.col("postal")).alias("zip5"),
        zip_plus4(F.col("postal")).alias("plus4"),
        zip_plus4(F.col("postal"), "digits").alias("plus4_digits"),
    )


@verify("""
    WITH d AS (
      SELECT doc_id, CASE WHEN lang = 'en' THEN '   ' WHEN lang <> 'de' THEN lang END AS lang,
             CASE WHEN n_chars > 2000 THEN text WHEN n_chars > 500 THEN '' END AS text
      FROM documents)
    SELECT doc_id,
           CASE WHEN lang IS NULL OR trim(lang) = '' THEN 'DESCRIPTION NOT AVAILABLE' ELSE lang END AS lang,
           md5(CASE WHEN text IS NULL OR trim(text) = '' THEN 'DESCRIPTION NOT AVAILABLE' ELSE text END) AS text_md5,
           text IS NOT NULL AND trim(text) <> '' AS has_text
    FROM d
""")
def silver_blank_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    lang = F.when(F.col("lang") == "en", "   ").when(F.col("lang") != "de", F.col("lang"))
    text = F.when(F.col("n_chars") > 2000, F.col("text")).when(F.col("n_chars") > 500, "")
    raw = table(spark, sf_dir, "documents").select("doc_id", lang.alias("lang"), text.alias("text"))
    return raw.select(
        "doc_id",
        blank_to(F.col("lang")).alias("lang"),
        F.md5(blank_to(F.col("text"))).alias("text_md5"),
        has_text(F.col("text")).alias("has_text"),
    )


@verify("""
    SELECT o_orderkey AS provider_id, strftime(o_orderdate, '%Y-%m-%d') AS begin_date,
           coalesce(end_date, '2299-12-31') AS end_date,
           CASE WHEN end_date IS NULL OR end_date = '2299-12-31' THEN 'Y' ELSE 'N' END AS is_active
    FROM (SELECT *, CASE o_orderstatus WHEN 'F' THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 'P' THEN '2299-12-31' END AS end_date
          FROM orders)
""")
def silver_xref_active(spark: SparkSession, sf_dir: str) -> DataFrame:
    day, status = F.date_format("o_orderdate", "yyyy-MM-dd"), F.col("o_orderstatus")
    end = F.when(status == "F", day).when(status == "P", "2299-12-31")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("provider_id"),
        day.alias("begin_date"),
        open_end(end).alias("end_date"),
        active_flag(end).alias("is_active"),
    )


@verify("""
    SELECT c_custkey, CASE WHEN rating >= 4.0 THEN 'Excellent' WHEN rating >= 3.0 THEN 'Good'
                           WHEN rating >= 2.0 THEN 'Fair' ELSE 'Poor' END AS rating_category
    FROM (SELECT c_custkey, CAST(c_acctbal AS DECIMAL(18,2)) / 2000 AS rating, c_mktsegment FROM customer)
    WHERE rating IS NOT NULL AND c_mktsegment IS NOT NULL
""")
def rating_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    rated = table(spark, sf_dir, "customer").where(F.col("c_acctbal").isNotNull() & F.col("c_mktsegment").isNotNull())
    rating = F.col("c_acctbal").cast("decimal(18,2)") / 2000
    return rated.select("c_custkey", rating_category(rating).alias("rating_category"))


@verify("""
    SELECT p_partkey, CASE WHEN p_size > 0 AND p_size <= 10 THEN 'Young' WHEN p_size > 10 AND p_size <= 25 THEN 'Middle'
                           WHEN p_size > 25 AND p_size <= 40 THEN 'Senior' END AS age_group
    FROM part
""")
def age_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    bins = right_closed_bins(F.col("p_size"), (0, 10, 25, 40), ("Young", "Middle", "Senior"))
    return table(spark, sf_dir, "part").select("p_partkey", bins.alias("age_group"))


_LINE_STEMS = ("qty", "flag", "price", "ship")


def wide_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order with seven groups of four columns, one group per line number."""
    at, money = F.col("l_linenumber"), F.col("l_extendedprice").cast("decimal(18,2)")
    groups = []
    for i in range(1, 8):
        groups += [
            F.sum(F.when(at == i, F.col("l_quantity").cast("bigint"))).cast("string").alias(f"qty_{i}"),
            F.char(F.max(F.when(at == i, F.ascii("l_returnflag")))).alias(f"flag_{i}"),
            F.sum(F.when(at == i, money)).cast("string").alias(f"price_{i}"),
            F.date_format(F.max(F.when(at == i, F.col("l_shipdate"))), "yyyy-MM-dd").alias(f"ship_{i}"),
        ]
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(*groups)


@verify("""
    SELECT l_orderkey, CAST(l_linenumber AS VARCHAR) AS seq_id,
           CAST(CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS VARCHAR) AS qty, max(l_returnflag) AS flag,
           CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS VARCHAR) AS price,
           strftime(max(l_shipdate), '%Y-%m-%d') AS ship
    FROM lineitem GROUP BY l_orderkey, l_linenumber
""")
def unpivot_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unpivot_groups(wide_lines(spark, sf_dir), ["l_orderkey"], _LINE_STEMS, 7, "seq_id")


_ID_STEMS = ("ident", "kind", "state", "issuer")


@verify("""
    SELECT o_custkey, CAST(1 + o_orderkey % 50 AS VARCHAR) AS seq_id, CAST(max(o_orderkey) AS VARCHAR) AS ident,
           strftime(min(o_orderdate), '%Y-%m-%d') AS kind, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS VARCHAR) AS state,
           CAST(count(*) AS VARCHAR) AS issuer
    FROM orders GROUP BY o_custkey, o_orderkey % 50
""")
def unpivot_groups_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fifty groups of four columns per customer, back to one row per filled group."""
    slots = list(range(1, 51))
    orders = table(spark, sf_dir, "orders")
    # by customer once, for both steps of the pivot; a task holds its customers' 200 columns
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), orders.count() // 500_000)
    keyed = orders.withColumn("slot", 1 + F.col("o_orderkey") % 50).repartition(tasks, "o_custkey")
    wide = keyed.groupBy("o_custkey").pivot("slot", slots).agg(
        F.max("o_orderkey").cast("string").alias("ident"),
        F.date_format(F.min("o_orderdate"), "yyyy-MM-dd").alias("kind"),
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("string").alias("state"),
        F.count(F.lit(1)).cast("string").alias("issuer"),
    )
    wide = wide.withColumnsRenamed({f"{i}_{s}": f"{s}_{i}" for i in slots for s in _ID_STEMS})
    return unpivot_groups(wide, ["o_custkey"], _ID_STEMS, len(slots), "seq_id")


_ADDRESS_SQL = """
    SELECT o_orderkey AS NPI,
      CASE o_orderstatus WHEN 'F' THEN o_orderpriority WHEN 'P' THEN '  ' END AS m1, o_orderstatus AS m2,
      'CITY ' || (o_custkey % 97) AS m3, CASE WHEN o_totalprice > 250000 THEN 'NY' ELSE 'New York' END AS m4,
      lpad(CAST(o_custkey AS VARCHAR), 5, '0') || '-' || lpad(CAST(o_orderkey % 9999 AS VARCHAR), 4, '0') AS m5, 'US' AS m6,
      lpad(CAST(o_orderkey AS VARCHAR), 10, '9') AS m7, lpad(CAST(o_orderkey AS VARCHAR), 9, '9') AS m8,
      CASE WHEN o_orderstatus <> 'O' THEN o_orderpriority || ' practice' ELSE '' END AS s1, NULL AS s2,
      'TOWN ' || (o_custkey % 89) AS s3, o_orderstatus AS s4, lpad(CAST(o_custkey AS VARCHAR), 9, '1') AS s5, NULL AS s6,
      '(' || lpad(CAST(o_orderkey AS VARCHAR), 10, '8') || ')' AS s7, NULL AS s8
    FROM orders"""


def _address_branch(kind: str, p: str) -> str:
    digits = "length(regexp_replace({c}, '[^0-9]', '', 'g')) = 10"
    cols = {
        ADDRESS_COLUMNS[0]: f"{p}1",
        ADDRESS_COLUMNS[1]: f"{p}2",
        ADDRESS_COLUMNS[2]: f"{p}3",
        ADDRESS_COLUMNS[3]: f"CASE WHEN length({p}4) = 2 THEN {p}4 END",
        ADDRESS_COLUMNS[4]: f"substring({p}5, 1, 5)",
        ADDRESS_COLUMNS[5]: f"CASE WHEN length({p}5) > 5 THEN substring({p}5, 7, 4) END",
        ADDRESS_COLUMNS[6]: f"{p}6",
        ADDRESS_COLUMNS[7]: f"CASE WHEN {digits.format(c=p + '7')} THEN {p}7 END",
        ADDRESS_COLUMNS[8]: f"CASE WHEN {digits.format(c=p + '8')} THEN {p}8 END",
    }
    listed = ", ".join(f"CAST({v} AS VARCHAR) AS {k}" for k, v in cols.items())
    return f"SELECT NPI, '{kind}' AS PROVIDER_ADDRESS_TYPE, {listed} FROM a WHERE {p}1 IS NOT NULL AND trim({p}1) <> ''"


@verify(f"WITH a AS ({_ADDRESS_SQL}) {_address_branch('M', 'm')} UNION ALL {_address_branch('S', 's')}")
def address_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    cust, order = F.col("o_custkey").cast("string"), F.col("o_orderkey").cast("string")
    none = F.lit(None).cast("string")
    mailing = [
        F.when(status == "F", priority).when(status == "P", "  "),
        status,
        F.concat(F.lit("CITY "), F.col("o_custkey") % 97),
        F.when(F.col("o_totalprice") > 250000, "NY").otherwise("New York"),
        F.concat(F.lpad(cust, 5, "0"), F.lit("-"), F.lpad((F.col("o_orderkey") % 9999).cast("string"), 4, "0")),
        F.lit("US"),
        F.lpad(order, 10, "9"),
        F.lpad(order, 9, "9"),
    ]
    practice = [
        F.when(status != "O", F.concat(priority, F.lit(" practice"))).otherwise(""),
        none,
        F.concat(F.lit("TOWN "), F.col("o_custkey") % 89),
        status,
        F.lpad(cust, 9, "1"),
        none,
        F.concat(F.lit("("), F.lpad(order, 10, "8"), F.lit(")")),
        none,
    ]
    named = zip([*MAILING_ADDRESS, *PRACTICE_ADDRESS], [*mailing, *practice], strict=True)
    wide = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("NPI"), *[v.alias(k) for k, v in named])
    return split_addresses(wide, ["NPI"])


def _hash_columns() -> list:
    brand = F.when(F.col("p_size") > 10, F.col("p_brand"))
    price = F.col("p_retailprice").cast("decimal(18,2)")
    kind = F.when(F.col("p_brand") != "Brand#7", F.col("p_type"))
    return [F.col("p_name"), brand, kind, F.col("p_size"), price]


_HASH_SQL = """
    SELECT p_partkey, md5(concat_ws('{sep}', coalesce(p_name, ''), CASE WHEN p_size > 10 THEN p_brand ELSE '' END,
             CASE WHEN p_brand <> 'Brand#7' THEN p_type ELSE '' END, CAST(p_size AS VARCHAR),
             CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS VARCHAR))) AS row_hash
    FROM part"""


@verify(_HASH_SQL.format(sep=""))
def row_hash_plain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", row_hash(_hash_columns()).alias("row_hash"))


@verify(_HASH_SQL.format(sep="|"))
def row_hash_delim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", row_hash(_hash_columns(), PIPE).alias("row_hash"))
