"""Values of many shapes over the driver tables: e-mails, names, dates, and transactions that arrive as strings.

Row k of a table gets shape ``k % number of shapes``, so every shape occurs in
all parts of a table and the work grows with it. The templates say what
arrives; ``tablegate.plans.shape_oracle`` says, shape by shape and without the
library's patterns, what should become of it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablegate.session import materialize, run_folder
from tablegate.sources.dirty import dirty_transactions, table

# --- Fixed values: what arrives, ``{k}`` being the row's key ------------------
EMAILS = (
    "user{k}@mail.com",
    " user{k}@mail.com\t",
    "Ann Lee <user{k}@mail.com>",
    "user+tag{k}@mail.co.uk",
    "user{k}@mail",
    "user..{k}@mail.com",
    "user{k}.@mail.com",
    "user{k}@-mail.com",
    "user{k}@mail.test",
    "user{k}@mail.localhost",
    "a" * 64 + "{k}@mail.com",
    "user{k}@" + "b" * 64 + ".com",
    "user{k}@" + "b" * 63 + ".com",
    "user {k}@mail.com",
    "user{k}@@mail.com",
    "user{k}@mail.com\n",
    "{k}",
    "user{k}@münchen.de",
)
NAMES = (
    "Ann {k}",
    "",
    " ",
    "\t",
    "\u00a0",
    "\u3000",
    "\n\r\n",
    " \t{k}\u00a0",
    "\x1c\x1f",
    "\u200b",
    ".",
    "\u2003\u2028",
    "0",
)
DATES = (
    "2025-02-28",
    "2025-02-30",
    "2024-02-29",
    "2023-02-29",
    "2025-1-1",
    "2025-13-01",
    "2025-00-10",
    " 2025-01-01",
    "2025-01-01\n",
    "2025-01-01T00:00:00",
    "0000-01-01",
    "20250101",
    "01-02-2025",
    "25-01-01",
    "9999-12-31",
    "2025/01/01",
    "",
    "2025-04-31",
    "0001-01-01",
)
# Residues of the key and what replaces the id (``{k}``) or the amount (``{a}``).
ID_MODULUS = 101
ID_TEXTS = {
    1: "  {k} ",
    2: "{k}.0",
    3: "{k}.5",
    4: "1_{k}",
    5: "{k}_",
    6: "{k}e3",
    7: "0x{k}",
    8: "99999999999999999999",
    9: "",
    10: "+{k}",
}
AMOUNT_MODULUS = 103
AMOUNT_TEXTS = {
    1: "\u00a0{a}\t",
    2: "1e3",
    3: "nan",
    4: "1_0.5",
    5: "0",
    6: "-0.0",
    7: "12.5d",
    8: "0x1p3",
    9: "_5",
    10: "1__0",
    11: ".5",
    12: "5.",
    13: "-{a}",
    14: "",
    15: "12,5",
    16: "-inf",
    17: "INF",
}
# Long values: so many times the unit, then the tail.
LONG = (
    ("a ", ""),
    ("1_", "1"),
    ("0_", "7"),
    (" ", "7"),
    (" ", ""),
    (".", ""),
    ("a.", "a@mail.com"),
    ("9", "x"),
    ("<", ""),
    ("a@", "mail.com"),
    ("", "user@mail.com"),
    ("1e", "1"),
    ("a ", "<user@mail.com>"),
    ("0", ".50"),
    ("-", "1"),
    ("a@b.", "com"),
    ("2025-01-01", ""),
    ("\u3000", "a"),
    ('"', "<user@mail.com>"),
    ("1.", "0"),
)
LONG_REPEATS = 2_048
LONGEST_REPEATS = 524_288
LONGEST = (797, 5)
# Broken lines: cut after two fields, a field too many, a quote that does not end.
LINE_CUT = (53, 7)
LINE_LONG = (59, 8)
LINE_QUOTE = (61, 9)
KEY_LETTER = (37, 1)
DATE_MISSING = (47, 4)
# -----------------------------------------------------------------------------


def _shaped(key: Column, templates: tuple[str, ...]) -> Column:
    """The key in its template; one literal array, as the rules repeat this expression many times."""
    template = F.element_at(F.array(*map(F.lit, templates)), (key % len(templates) + 1).cast("int"))
    return F.replace(template, F.lit("{k}"), key.cast("string"))


def _replaced(key: Column, modulus: int, templates: dict[int, str], value: Column, mark: str) -> Column:
    """The value, or where the key has a residue with a template, the value in that template."""
    pairs = F.create_map(*[F.lit(x) for pair in templates.items() for x in pair])
    template = F.try_element_at(pairs, (key % modulus).cast("int"))
    return F.replace(F.coalesce(template, F.lit(mark)), F.lit(mark), value)


def shaped_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(customer_id, email, name)``, every customer with one of the shapes."""
    k = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        k.alias("customer_id"), _shaped(k, EMAILS).alias("email"), _shaped(k, NAMES).alias("name")
    )


def shaped_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(transaction_id, date)``, every order with one of the shapes."""
    k = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(k.alias("transaction_id"), _shaped(k, DATES).alias("date"))


def spread(df: DataFrame) -> DataFrame:
    """The same rows in enough partitions for all cores.

    A scan is divided by the bytes of its files. Keys that become values a thousand times as long are still one
    task then, and all work on the values with them. So they are dealt into files, of which Spark reads some in each core.
    """
    spark = df.sparkSession
    files = 4 * spark.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= files:
        return df
    return materialize(df.repartition(files), f"{run_folder(spark, 'spread')}/rows")


def long_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(customer_id, value)``: every customer with a long value, some of up to 2 MB."""
    k = F.col("c_custkey")
    modulus, residue = LONGEST
    times = F.when(k % modulus == residue, F.lit(LONGEST_REPEATS)).otherwise(F.lit(LONG_REPEATS))
    unit, tail = (F.element_at(F.array(*[F.lit(x[i]) for x in LONG]), (k % len(LONG) + 1).cast("int")) for i in (0, 1))
    keys = spread(table(spark, sf_dir, "customer").select("c_custkey"))
    return keys.select(k.alias("customer_id"), F.concat(F.repeat(unit, times), tail).alias("value"))


def transaction_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(value)``: the dirty transactions as CSV lines without a header, some of them broken."""
    t = dirty_transactions(spark, sf_dir)
    k = F.col("transaction_id")
    head = F.concat_ws(",", k, "customer_id")
    tail = F.concat_ws(",", F.coalesce(F.col("amount").cast("decimal(18,2)").cast("string"), F.lit("")), "date")
    hit = {m: k % m == r for m, r in (LINE_CUT, LINE_LONG, LINE_QUOTE)}
    line = (
        F.when(hit[LINE_CUT[0]], head)
        .when(hit[LINE_LONG[0]], F.concat_ws(",", head, tail, F.lit("more")))
        .when(hit[LINE_QUOTE[0]], F.concat(head, F.lit(',"'), tail))
    )
    return t.select(F.coalesce(line, F.concat_ws(",", head, tail)).alias("value"))


def string_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order as four strings, some of them no numbers, or numbers of unusual shape."""
    k = F.col("o_orderkey")
    amount = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    key = F.col("o_custkey").cast("string")
    return table(spark, sf_dir, "orders").select(
        _replaced(k, ID_MODULUS, ID_TEXTS, k.cast("string"), "{k}").alias("transaction_id"),
        F.when(k % KEY_LETTER[0] == KEY_LETTER[1], F.concat(F.lit("c"), key)).otherwise(key).alias("customer_id"),
        _replaced(k, AMOUNT_MODULUS, AMOUNT_TEXTS, amount, "{a}").alias("amount"),
        F.when(k % DATE_MISSING[0] != DATE_MISSING[1], F.date_format("o_orderdate", "yyyy-MM-dd")).alias("date"),
    )
