"""Lines made from the test tables, parsed, streamed and stored; every line of a table takes part."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acceptance.cleaning import KEYS, lost_sql
from acceptance.crosswalk import VIEWS, view, view_sql
from acceptance.registry import ORACLES, query, table
from tablemill.operators.lost_values import lost_counts, lost_records, without_lost_values
from tablemill.plans import marketplace, warehouse
from tablemill.session import shared_dir
from tablemill.sinks.kafka import encoded
from tablemill.sinks.tables import append_table, append_tables
from tablemill.sources.lines import decoded, file_line_stream, lines_below_header, text_lines
from tablemill.sources.parsing import accepted, parse_lines, rejected
from tablemill.sources.records import RecordType
from tablemill.sources.tables import stored_table
from tablemill.streaming.ingest import ingest_lines

EVENT_RECORD = RecordType(
    "Events",
    "event_id bigint, day string, user_id bigint, event_type string, value double, props string",
    "\t",
    quoted=False,
)
PART_RECORD = RecordType(
    "Parts", "p_partkey bigint, p_name string, p_brand string, p_size bigint, p_retailprice double", ",", quoted=True
)


def _tab_line(df: DataFrame) -> Column:
    return F.concat_ws("\t", *(F.col(name).cast("string") for name in df.columns)).alias("value")


def _comma_line(df: DataFrame) -> Column:
    options = {"escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    return F.to_csv(F.struct(*df.columns), options).alias("value")


def _written_files(df: DataFrame, record: RecordType, purpose: str, *parts: str, folder: str | None = None) -> str:
    """Delimited files with header lines in the shared folder; with ``parts`` in one folder per value."""
    folder = folder or shared_dir(df.sparkSession, purpose)
    options = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false", "emptyValue": ""}
    quoting = {"escape": '"'} if record.quoted else {"quote": ""}
    writer = df.write.mode("append").options(header="true", sep=record.separator, **options, **quoting)
    writer.partitionBy(*parts).csv(folder)
    return folder


@query("parse_tab", f"SELECT * FROM {view_sql('event_records')}")
def parse_tab(spark, sf_dir):
    events = view(spark, sf_dir, "event_records")
    return accepted(parse_lines(events.select(_tab_line(events)), EVENT_RECORD))


@query("parse_comma_quoted", f"SELECT * FROM {view_sql('part_records')}")
def parse_comma_quoted(spark, sf_dir):
    parts = view(spark, sf_dir, "part_records")
    return accepted(parse_lines(parts.select(_comma_line(parts)), PART_RECORD))


@query("message_bytes", f"SELECT * FROM {view_sql('event_records')}")
def message_bytes(spark, sf_dir):
    """The records of all messages after the way to bytes and back."""
    events = view(spark, sf_dir, "event_records")
    return accepted(parse_lines(decoded(encoded(events.select(_tab_line(events)))), EVENT_RECORD))


# Errors carry text as their value, sign-ups end after three fields, views have a field too many.
_BROKEN_LINE = """
    CASE event_type
        WHEN 'error' THEN concat_ws('{tab}', event_id, day, user_id, event_type, 'n/a', props)
        WHEN 'signup' THEN concat_ws('{tab}', event_id, day, user_id)
        WHEN 'view' THEN concat_ws('{tab}', event_id, day, user_id, event_type, user_id, props, 'more')
        ELSE concat_ws('{tab}', event_id, day, user_id, event_type, user_id, props)
    END
"""


def _broken_lines(spark, sf_dir) -> DataFrame:
    return view(spark, sf_dir, "event_records").selectExpr(f"{_BROKEN_LINE.format(tab=chr(9))} AS value")


@query(
    "parse_rejects",
    f"""SELECT {_BROKEN_LINE.format(tab=chr(9))} AS value FROM {view_sql('event_records')}
        WHERE event_type IN ('error', 'signup', 'view')""",
)
def parse_rejects(spark, sf_dir):
    return rejected(parse_lines(_broken_lines(spark, sf_dir), EVENT_RECORD))


@query(
    "parse_accepted",
    f"""SELECT event_id, day, user_id, event_type, cast(user_id AS double) AS value, props
        FROM {view_sql('event_records')} WHERE event_type NOT IN ('error', 'signup', 'view')""",
)
def parse_accepted(spark, sf_dir):
    return accepted(parse_lines(_broken_lines(spark, sf_dir), EVENT_RECORD))


@query("text_scan", f"SELECT * FROM {view_sql('event_records')}")
def text_scan(spark, sf_dir):
    """Files with a known header line each."""
    events = view(spark, sf_dir, "event_records")
    folder = _written_files(events, EVENT_RECORD, "text-scan")
    return accepted(parse_lines(text_lines(spark, folder, EVENT_RECORD.header), EVENT_RECORD))


@query("delimited_scan", f"SELECT * FROM {view_sql('part_records')}")
def delimited_scan(spark, sf_dir):
    """Files that lose their first line, with quoted commas and doubled quotes."""
    parts = view(spark, sf_dir, "part_records")
    lines = lines_below_header(spark, _written_files(parts, PART_RECORD, "delimited-scan"))
    return accepted(parse_lines(lines, PART_RECORD))


@query("stream_ingest", f"SELECT * FROM {view_sql('event_records')}")
def stream_ingest(spark, sf_dir):
    """Line files as a stream; the second run finds nothing new."""
    events = view(spark, sf_dir, "event_records")
    folder = shared_dir(spark, "stream-ingest")
    events.select(_tab_line(events)).write.text(f"{folder}/lines")
    for _ in range(2):
        lines = file_line_stream(spark, f"{folder}/lines")
        rows = ingest_lines(lines, EVENT_RECORD, f"{folder}/table", f"{folder}/checkpoint")
    return accepted(rows)


@query("multi_part_union", f"SELECT * FROM {view_sql('benefits')}")
def multi_part_union(spark, sf_dir):
    """The benefits record in four parts, one stream over all of them, a bounded number of files per batch."""
    part = F.when(F.col("l_linenumber") <= 2, 1).when(F.col("l_linenumber") <= 4, 2)
    part = part.when(F.col("l_linenumber") <= 6, 3).otherwise(4).alias("part")
    lines = table(spark, sf_dir, "lineitem")
    columns = [F.expr(f"{value} AS {name}") for name, value in VIEWS["benefits"][1].items()]
    folder = _written_files(lines.select(*columns, part), marketplace.BENEFITS_COST_SHARING, "benefits", "part")
    return marketplace.benefits_cost_sharing(
        spark,
        f"{folder}/part=*",
        shared_dir(spark, "marketplace"),
        header=marketplace.BENEFITS_COST_SHARING.header,
        maxFilesPerTrigger="64",
    )


@query("ingest_plan_attributes", f"SELECT * FROM {view_sql('plan_attributes')}")
def ingest_plan_attributes(spark, sf_dir):
    rows = view(spark, sf_dir, "plan_attributes")
    path = _written_files(rows, marketplace.PLAN_ATTRIBUTES, "plan-attributes")
    return marketplace.plan_attributes(spark, path, shared_dir(spark, "marketplace"))


@query("ingest_network", f"SELECT * FROM {view_sql('network')}")
def ingest_network(spark, sf_dir):
    rows = view(spark, sf_dir, "network")
    path = _written_files(rows, marketplace.NETWORK, "network")
    return marketplace.network(spark, path, shared_dir(spark, "marketplace"))


@query("ingest_service_area", f"SELECT * FROM {view_sql('service_area')}")
def ingest_service_area(spark, sf_dir):
    rows = view(spark, sf_dir, "service_area")
    path = _written_files(rows, marketplace.SERVICE_AREA, "service-area")
    return marketplace.service_area(spark, path, shared_dir(spark, "marketplace"))


@query("ingest_insurance", f"SELECT * FROM {view_sql('insurance')}")
def ingest_insurance(spark, sf_dir):
    rows = view(spark, sf_dir, "insurance")
    path = _written_files(rows, marketplace.INSURANCE, "insurance")
    return marketplace.insurance(spark, path, shared_dir(spark, "marketplace"))


@query("collection_forward", f"SELECT * FROM {view_sql('insurance')}")
def collection_forward(spark, sf_dir):
    """From files to the landed table, from there to a second store; running both steps again adds nothing."""
    path = _written_files(view(spark, sf_dir, "insurance"), marketplace.INSURANCE, "insurance")
    lake = shared_dir(spark, "marketplace")
    for _ in range(2):
        marketplace.insurance(spark, path, lake)
        marketplace.to_collection(spark, marketplace.INSURANCE, lake, "json", target=f"{lake}/collection")
    return stored_table(spark, f"{lake}/collection", "json", marketplace.INSURANCE.schema)


@query("landed_periods", f"SELECT *, 'year=' || BusinessYear AS period FROM {view_sql('service_area')}")
def landed_periods(spark, sf_dir):
    """A folder of files, a stream and a table per year. Half of each year's files come late, when all years have been
    landed before."""
    areas = view(spark, sf_dir, "service_area").withColumn("year", F.col("BusinessYear"))
    late = F.pmod("IssuerId", F.lit(2)) == 1
    lake, arrived = shared_dir(spark, "marketplace"), shared_dir(spark, "periods")
    for rows in (areas.where(~late), areas.where(late)):
        path = _written_files(rows, marketplace.SERVICE_AREA, "periods", "year", folder=arrived)
        marketplace.land_periods(spark, marketplace.SERVICE_AREA, path, lake, header=marketplace.SERVICE_AREA.header)
    return accepted(marketplace.landed_periods(spark, marketplace.SERVICE_AREA, lake))


@query("append_roundtrip", "SELECT * FROM customer UNION ALL SELECT * FROM customer")
def append_roundtrip(spark, sf_dir):
    return _appended_twice(spark, sf_dir, "parquet")


@query("append_roundtrip_json", "SELECT * FROM customer UNION ALL SELECT * FROM customer")
def append_roundtrip_json(spark, sf_dir):
    return _appended_twice(spark, sf_dir, "json")


def _appended_twice(spark, sf_dir, fmt: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    folder = shared_dir(spark, f"append-{fmt}")
    for _ in range(2):
        append_table(customer, folder, fmt)
    return stored_table(spark, folder, fmt, customer.schema)


_LOADED = {"BRANCH": "clean_branch", "CREDITCARD": "clean_card", "CUSTOMER": "clean_customer"}


@query(
    "warehouse_load",
    " UNION ALL BY NAME ".join(
        f"SELECT '{name}' AS table_name, * FROM ({ORACLES[cleaning]})" for name, cleaning in _LOADED.items()
    ),
)
def warehouse_load(spark, sf_dir):
    """Cleans the three warehouse tables, appends them to their collections and reads all rows back."""
    loaded = [
        without_lost_values(rows).withColumn("table_name", F.lit(name)) for name, rows in _loaded(spark, sf_dir).items()
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), loaded)


def _loaded(spark, sf_dir) -> dict[str, DataFrame]:
    views = ("branch", "card", "customers")
    sources = {name: view(spark, sf_dir, source) for name, source in zip(warehouse.WAREHOUSE_TABLES, views)}
    cleaned = warehouse.clean_warehouse(sources, record_lost=True)
    folder = shared_dir(spark, "warehouse")
    append_tables(cleaned, folder)
    return {name: stored_table(spark, f"{folder}/{name}", schema=cleaned[name].schema) for name in _LOADED}


@query(
    "warehouse_load_lost",
    f"""SELECT table_name, column_name, source_name, count(*) AS n
        FROM ({" UNION ALL ".join(f"({lost_sql(name)})" for name in _LOADED)})
        GROUP BY table_name, column_name, source_name""",
)
def warehouse_load_lost(spark, sf_dir):
    """How many originals the loaded tables hold beside the cleaned rows that lost them."""
    return lost_counts(lost_records(_loaded(spark, sf_dir), KEYS))
