"""Result documents of reports with very many accounts, as lines that form the document in their order.

A document holds a map for each of the 271 columns of the account table, with an entry for each account. For a usual
report that is one row. For a report with a hundred thousand accounts it is not: such a document is written as lines, each
with at most ``rows_per_line`` entries of one column. Lines are cut between entries, where JSON allows white space, so the
lines of a request, one behind the other, are its document. Accounts are exploded before their columns are made, so a row
is never larger than one account or one line.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeline import schemas as s
from tradeline.config import CURRENT, PolicyConfig
from tradeline.functions.dates import AsOf, date_text
from tradeline.plans import export

#: Order of the lines: section, column of the section, part of the column.
_ORDER = ("section", "place", "part")


def _json(value: Column) -> Column:
    """A value as JSON text."""
    text = F.to_json(F.struct(value.alias("v")), {"ignoreNullFields": "false"})
    return F.substring(text, F.lit(6), F.length(text) - 6)


def _column_lines(
    rows: DataFrame, section: int, fields: Iterable[str], names: dict[str, str], rows_per_line: int
) -> DataFrame:
    """Lines of one section's columns. ``rows`` has request_id, i (from 0), n (rows of the request) and the fields."""
    fields = list(fields)
    key = F.concat(F.lit('"'), F.col("i").cast("string"), F.lit('":'))
    value = lambda name: date_text(F.col(name)) if name in s.DATE_COLUMNS else F.col(name)
    entries = F.array(*[F.concat(key, _json(value(name))) for name in fields])
    parts = rows.select("request_id", "i", "n", F.floor(F.col("i") / rows_per_line).cast("int").alias("part"), entries.alias("entries"))
    parts = parts.groupBy("request_id", "part").agg(
        F.max("n").alias("n"), F.array_sort(F.collect_list(F.struct("i", "entries"))).alias("rows")
    )
    heads = F.array(*[F.lit(f'"{names.get(name, name)}":{{') for name in fields])
    lines = parts.select("request_id", "part", "n", "rows", F.posexplode(heads).alias("place", "head"))
    first, last = F.col("part") == 0, F.col("part") == F.floor((F.col("n") - 1) / rows_per_line)
    before = F.when(first & (F.col("place") > 0), F.concat(F.lit(","), "head")).when(first, F.col("head")).otherwise(",")
    text = F.array_join(F.transform("rows", lambda r: F.get(r["entries"], F.col("place"))), ",")
    return lines.select(
        "request_id", F.lit(section).alias("section"), "place", "part",
        F.concat(before, text, F.when(last, "}").otherwise("")).alias("value"),
    )


def _text_lines(large: DataFrame, texts: dict[int, Column]) -> DataFrame:
    """Lines between the columns: section -> text, null for none."""
    lines = F.array(*[F.struct(F.lit(i).alias("section"), text.alias("value")) for i, text in texts.items()])
    rows = large.select("request_id", F.explode(lines).alias("l")).where("l.value IS NOT NULL")
    return rows.select("request_id", "l.section", F.lit(0).alias("place"), F.lit(0).alias("part"), "l.value")


def _indexed(large: DataFrame, items: Column) -> DataFrame:
    """A row for each item: request columns, item, i, n."""
    return large.withColumn("n", F.array_size(items)).select("*", F.posexplode(items).alias("i", "item"))


def result_lines(
    scored: DataFrame, as_of: AsOf, cfg: PolicyConfig = CURRENT, rows_per_line: int = 500
) -> DataFrame:
    """request_id, line, value: the result documents of all processed requests.

    A request with at most ``rows_per_line`` accounts and enquiries has one line, which ``export.result_documents`` makes.
    The lines of a larger one form its document in the order of ``line``.
    """
    if not rows_per_line > 0:
        raise ValueError("a line holds at least one row")
    good = scored.where(F.col("error_reason").isNull())
    sizes = F.greatest(*[F.coalesce(F.array_size(F.col(c)), F.lit(0)) for c in ("accounts", "enquiries")])
    large = good.where(sizes > rows_per_line)
    small = export.result_documents(good.where(sizes <= rows_per_line), as_of, cfg)
    one = small.select("request_id", F.lit(0).cast("long").alias("line"), "value")

    names = {} if cfg.envelope else s.launch_names(cfg.user_column)
    bureau = [n for n, _ in s.bureau_fields(cfg.user_column)]
    accounts = _indexed(large, export.account_rows()).withColumnRenamed("item", "row")
    accounts = export.account_columns(accounts, cfg, keys=("request_id", "i", "n"))
    enquiries = _indexed(large, F.col("enquiries"))
    columns = export.enquiry_columns(F.col("item"), as_of, cfg)
    enquiries = enquiries.select("request_id", "i", "n", *[v.alias(n) for n, v in columns.items()])
    user = export.user_document(cfg)
    said = lambda name, value: F.concat(F.lit(f'"{name}":'), _json(value))
    comma = F.lit(",")
    if cfg.envelope:
        head = F.concat(
            F.lit("{"), said("accept_ind", F.col("accept_ind")), comma,
            said("bureau_history_status", F.col("bureau_history_status")), comma, said("bnpl_limit", F.col("bnpl_limit")),
            F.lit(',"analytics_data":{"bur_processed_bnpl_data":{'),
        )
        table, tail = "enquiry_bnpl_data", F.concat(comma, said("user_aggregated_policy_data", user), F.lit("}}"))
    else:
        head = F.concat(F.lit("{"), said("Bur_Hist_Sta", F.col("bureau_history_status")), F.lit(',"Bur_Data":{'))
        table, tail = "Enq_Data", F.concat(comma, said("df_User", user), comma, said("Accpt_Ind", F.col("accept_ind")), F.lit("}"))
    no_rows = lambda fields: ",".join(f'"{names.get(n, n)}":{{}}' for n in fields)
    head = F.concat(head, F.when(F.array_size(export.account_rows()) == 0, no_rows(bureau)).otherwise(""))
    none = F.array_size("enquiries") == 0
    between = F.concat(
        F.lit(f'}},"{table}":'),
        F.when(F.col("enquiries").isNull(), "null").when(none, "{" + no_rows(n for n, _ in s.ENQUIRY_OUT_FIELDS) + "}").otherwise("{"),
    )
    closed = F.when(F.col("enquiries").isNull() | none, F.lit("")).otherwise("}")
    lines = _text_lines(large, {0: head, 2: between, 4: F.concat(closed, tail)})
    lines = lines.unionByName(_column_lines(accounts, 1, bureau, names, rows_per_line))
    lines = lines.unionByName(_column_lines(enquiries, 3, [n for n, _ in s.ENQUIRY_OUT_FIELDS], names, rows_per_line))
    # Sections, columns (fewer than a thousand) and parts in one number.
    number = F.col("section").cast("long") * 1000 + F.col("place")
    line = F.shiftleft(number, 40) + F.col("part")
    return one.unionByName(lines.select("request_id", line.alias("line"), "value"))


def write_lines(lines: DataFrame, path: str) -> None:
    """Write the lines in order: parts of the output follow each other by request and line."""
    ordered = lines.repartitionByRange("request_id", "line").sortWithinPartitions("request_id", "line")
    ordered.write.parquet(path)
