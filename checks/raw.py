"""The given tables in raw form, for checking the jobs that read raw files and the feed.

``orders`` become lines of the tab-separated history, ``events`` lines of the change feed,
both with rows that the jobs have to drop or repair.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast import schema
from holdfast.sources.views import EVENT_K, project, table

#: Lines of a landed history file at most, and at least if there is more than one file.
LINES_A_FILE, FEWEST_LINES_A_FILE = 1_000_000, 50_000
#: About how many blocks of the feed land in one file.
BLOCKS_A_FILE = 250_000

# Some rows are not revisions, made by bots, anonymous (or unknown to be), in other or
# unknown namespaces, or have no readable time.
_ORDER_RAW = {
    "wiki_db": "'orders'",
    "event_entity": "if(o_orderkey % 11 = 0, 'user', 'revision')",
    "event_type": "'create'",
    "event_timestamp": """if(o_orderkey % 97 = 0, 'junk',
                            date_format(o_orderdate, 'yyyy-MM-dd HH:mm:ss.S'))""",
    "event_comment": """if(o_orderkey % 5 > 1, concat('said "order" ', o_orderkey), '')""",
    "event_user_id": "o_custkey",
    "event_user_text": "concat('customer ', o_custkey)",
    "event_user_is_bot_by": "if(o_orderkey % 13 = 0, 'name,group', '')",
    "event_user_is_anonymous": """CASE WHEN o_orderkey % 17 = 0 THEN 'true'
                                  WHEN o_orderkey % 17 > 1 THEN 'false' ELSE '' END""",
    "event_user_revision_count": "o_orderkey % 50",
    "page_id": "o_orderkey % 1000",
    "page_namespace": """if(o_orderkey % 19 = 0, '',
                           string(int(substring(o_orderpriority, 1, 1)) - 1))""",
    "revision_id": "o_orderkey",
    "revision_minor_edit": "o_orderkey % 3 = 0",
    "revision_text_bytes": "bigint(round(o_totalprice))",
    "revision_text_bytes_diff": """if(o_orderkey % 7 > 0,
                                     string(bigint(round(o_totalprice)) - 200000), '')""",
    "revision_is_identity_reverted": "o_orderstatus = 'F'",
    "revision_is_identity_revert": "false",
}

# Some lines are bot edits, edits of another wiki, page creations, lines without a length,
# and lines that are not JSON.
_EVENT_CHANGE = f"""
if(event_id % 101 = 0, '{{"wiki": broken', to_json(named_struct(
  'wiki', if(event_id % 7 = 0, 'otherwiki', 'mainwiki'),
  'type', if(event_id % 5 = 0, 'new', 'edit'),
  'bot', if(event_id % 11 < 8, event_id % 11 = 0, NULL),
  'user', string(user_id),
  'title', concat('page ', event_id),
  'namespace', if(event_id % 9 > 0, int(event_id % 3), NULL),
  'timestamp', unix_timestamp(timestamp(ts)),
  'length', if(event_id % 13 > 0, named_struct('old', 50L, 'new', {EVENT_K}), NULL),
  'comment', if(event_id % 4 > 0, event_type, NULL),
  'minor', {EVENT_K} % 2 = 1,
  'tags', if(event_id % 6 = 0, array('mobile', 'mw-revert'), NULL)
))) AS value
"""


def orders_as_raw(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    """Orders as the text cells of the raw history, with rows that cleaning has to drop.

    ``spread`` deals them out to tasks of like size, see :func:`history_files`.
    """
    orders = table(spark, sf_dir, "orders")
    if spread:
        files = history_files(orders.count(), spark.sparkContext.defaultParallelism)
        orders = orders.repartition(files, *orders.columns)
    as_text = schema.struct(", ".join(f"{c} string" for c in schema.RAW.fieldNames()))
    return project(orders, as_text, _ORDER_RAW, default="''")


def history_files(rows: int, cores: int) -> int:
    """In how many files to land a history. Compressing takes most of the time, so all cores get
    the same number of files, unless these would be small."""
    rounds = -(-rows // (LINES_A_FILE * cores))
    return max(1, min(rounds * cores, -(-rows // FEWEST_LINES_A_FILE)))


def events_as_changes(events: DataFrame) -> DataFrame:
    """Events as change-feed JSON lines in a ``value`` column; works on a stream too."""
    return events.selectExpr(_EVENT_CHANGE)


def write_revision_tsv(raw: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Land rows as bz2-compressed tab-separated text, without header or quoting."""
    cells = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in raw.columns]
    (
        raw.select(F.concat_ws("\t", *cells).alias("value"))
        .write.mode(mode)
        .option("compression", "bzip2")
        .text(path)
    )


# Blocks of the feed: some with comments, of other types, without an id, with their data on two
# lines or after a block of nothing but a comment.
_EVENT_BLOCK = """
concat(if(event_id % 50 = 1, ':ping\n\n', ''), concat_ws('\n',
  if(event_id % 8 = 0, ': kept alive', NULL),
  CASE event_id % 6 WHEN 5 THEN 'event: canary' WHEN 4 THEN NULL ELSE 'event: message' END,
  if(event_id % 10 < 9, concat('id:', event_id), NULL),
  if(event_id % 12 = 0, 'retry: 100', NULL),
  if(event_id % 3 = 0, concat('data: {\ndata:', substring(value, 2)), concat('data: ', value))
)) AS value
"""


def events_as_blocks(events: DataFrame) -> DataFrame:
    """Events as blocks of the framed feed, with their ``event_id``."""
    lines = events.selectExpr("event_id", _EVENT_CHANGE)
    return lines.selectExpr("event_id", _EVENT_BLOCK)


def land_blocks(blocks: DataFrame, path: str) -> None:
    """Land blocks in more files, in the order of their ids.

    A task sorts and writes one range of ids, so its memory does not grow with the table. Tasks
    end in any order; the files get one time, by which all are later than what landed before,
    and among them their names tell the order.
    """
    files = max(1, -(-blocks.count() // BLOCKS_A_FILE))
    order = ("event_id", "value")
    ranges = blocks.repartitionByRange(files, *order).sortWithinPartitions(*order)
    before = _modified(blocks.sparkSession, path)
    ranges.select("value").write.mode("append").option("lineSep", "\n\n").text(path)
    _land_at_once(blocks.sparkSession, path, before)


def _file_system(spark: SparkSession, path: str):
    """The folder as Hadoop names it, and the file system that it lies on."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _modified(spark: SparkSession, path: str) -> dict[str, int]:
    """Names of the files in a folder, and when they were modified, in milliseconds."""
    where, system = _file_system(spark, path)
    if not system.exists(where):
        return {}
    found = [f for f in system.listStatus(where) if f.getPath().getName().startswith("part-")]
    return {f.getPath().getName(): f.getModificationTime() for f in found}


def _land_at_once(spark: SparkSession, path: str, before: dict[str, int]) -> None:
    """Give the files that are not among those of ``before`` one time, later than theirs."""
    where, system = _file_system(spark, path)
    new = {name: at for name, at in _modified(spark, path).items() if name not in before}
    end = max([*new.values(), *[at + 1 for at in before.values()]], default=0)
    for name in new:
        system.setTimes(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(where, name), end, -1)
    if any(at != end for name, at in _modified(spark, path).items() if name in new):
        raise RuntimeError(f"the file system of {path} does not keep the times it is given")


def land_by_month(orders: DataFrame, path: str) -> None:
    """One text file per month of orders. Months 5 and 10 are left out, those of months 7 are
    empty but for a line end, and orders whose key is a multiple of 97 have no month."""
    month = F.when(F.expr("o_orderkey % 97 > 0"), F.date_format("o_orderdate", "yyyy-MM"))
    text = F.concat(F.lit("order number "), "o_orderkey").alias("value")
    rows = orders.select(month.alias("ym"), text)
    number = F.coalesce(F.substring("ym", 6, 2).cast("int"), F.lit(0))
    empty = rows.filter(number == 7).select("ym", F.lit("").alias("value")).distinct()
    full = rows.filter(~number.isin(5, 7, 10))
    full.unionByName(empty).repartition("ym").write.partitionBy("ym").text(path)


# The same fields in other JSON types: flags as numbers or texts, numbers as texts or with
# decimals, tags as one text, a length without one side.
_ODD_CHANGE = f"""
concat('{{"wiki": "mainwiki", "type": "edit", "bot": ',
  CASE event_id % 7 WHEN 0 THEN 'true' WHEN 1 THEN '1' WHEN 2 THEN '0' WHEN 3 THEN 'null'
                    WHEN 4 THEN '""' ELSE 'false' END,
  ', "user": "', user_id, '", "title": "page ', event_id, '", "namespace": ',
  CASE event_id % 4 WHEN 0 THEN '"1"' WHEN 1 THEN '1.0' WHEN 2 THEN 'null' ELSE '2' END,
  ', "timestamp": ',
  CASE event_id % 3 WHEN 0 THEN string(unix_timestamp(timestamp(ts)))
                    WHEN 1 THEN concat(unix_timestamp(timestamp(ts)), '.0')
                    ELSE concat('"', unix_timestamp(timestamp(ts)), '"') END,
  CASE event_id % 5 WHEN 0 THEN ', "length": {{"old": 1, "new": 2.0}}'
                    WHEN 1 THEN ', "length": {{"new": "7"}}' WHEN 2 THEN ', "length": null'
                    WHEN 3 THEN concat(', "length": {{"old": ', {EVENT_K}, ', "new": 50}}')
                    ELSE '' END,
  ', "minor": ',
  CASE event_id % 6 WHEN 0 THEN '1' WHEN 1 THEN '0' WHEN 2 THEN 'true' WHEN 3 THEN 'false'
                    WHEN 4 THEN 'null' ELSE '"yes"' END,
  ', "tags": ',
  CASE event_id % 4 WHEN 0 THEN '"mw-revert"' WHEN 1 THEN '["a", "mw-revert"]' WHEN 2 THEN '[]'
                    ELSE 'null' END,
  ', "comment": "', event_type, '"}}') AS value
"""

# Broken envelopes, envelopes without most fields, and whole ones.
_BAD_ENVELOPE = f"""
CASE event_id % 5
  WHEN 0 THEN '{{"user": broken'
  WHEN 1 THEN concat('{{"user": "', user_id, '", "title": "page ', event_id, '"}}')
  ELSE to_json(named_struct('user', string(user_id), 'title', concat('page ', event_id),
    'namespace', event_id % 3, 'ts', unix_timestamp(timestamp(ts)),
    'bytes_diff', {EVENT_K} - 50, 'comment', event_type, 'minor', event_id % 2,
    'is_revert', 0))
END AS value
"""

#: A saved model with round numbers.
PLAIN_MODEL = {
    "intercept": -0.5,
    "weights": {f: 0.1 * (i + 1) for i, f in enumerate(schema.FEATURE_COLS)},
    "means": {f: 0.25 * i for i, f in enumerate(schema.FEATURE_COLS)},
    "stds": {f: 1.0 + i for i, f in enumerate(schema.FEATURE_COLS)},
}


def events_as_odd_changes(events: DataFrame) -> DataFrame:
    return events.selectExpr(_ODD_CHANGE)


def events_as_bad_envelopes(events: DataFrame) -> DataFrame:
    return events.selectExpr(_BAD_ENVELOPE)
