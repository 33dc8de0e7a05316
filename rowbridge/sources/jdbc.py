"""JDBC scans: URLs and options per database, optionally split by key range."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from rowbridge.operators.splits import range_predicates, split_ranges
from rowbridge.sources.tables import clean_where

# Driver classes, default fetch sizes and URL parameters.
DRIVERS = {
    "mysql": "com.mysql.cj.jdbc.Driver",
    "postgresql": "org.postgresql.Driver",
    "hive": "org.apache.hive.jdbc.HiveDriver",
    "odps": "com.aliyun.odps.jdbc.OdpsDriver",
}
FETCH_SIZE = {"mysql": 1000, "postgresql": 1000}
DEFAULT_FETCH_SIZE = 5000
URL_PARAMETERS = {
    "mysql": {
        "rewriteBatchedStatements": "true",
        "useUnicode": "true",
        "characterEncoding": "utf8",
        "useCursorFetch": "true",
        "serverTimezone": "GMT%2B8",
    },
    "hive": {
        "useUnicode": "true",
        "characterEncoding": "utf8",
        "hive.resultset.use.unique.column.names": "false",
    },
}


def _joined(parameters: dict, sep: str) -> str:
    return sep.join(f"{k}={v}" for k, v in parameters.items() if str(k).strip() and str(v).strip())


def jdbc_url(kind: str, connection: dict) -> str:
    """JDBC URL of a job's ``connection`` block."""
    kind = kind.lower()
    given = connection.get("jdbcUrlParam") or {}
    parameters = {**URL_PARAMETERS.get(kind, {}), **{k: v for k, v in given.items() if v is not None}}
    host, port, database = (connection.get(k, "") for k in ("ip", "port", "database"))
    if kind == "hive":
        name = "" if database == "default" else database
        auth = ""
        if connection.get("authMechanism") == "KERBEROS":
            auth = f"principal={connection['kerberosServiceName']['principal']}"
        elif connection.get("authMechanism") == "PLAIN":
            auth = f"user={connection.get('username')};password={connection.get('password')}"
        return f"jdbc:hive2://{host}:{port}/{name};{auth};{_joined(parameters, ';')}"
    if kind == "odps":
        named = {
            "accessId": connection.get("accessId", ""),
            "accessKey": connection.get("accessKey", ""),
            "endpoint": connection.get("odpsServer", ""),
            "tunnelEndpoint": connection.get("tunnelServer", ""),
        }
        project = connection.get("project") or database
        return f"jdbc:odps:{project}?{_joined({**named, **parameters}, ';')}"
    if kind not in ("mysql", "postgresql"):
        raise ValueError(f"unknown database kind: {kind}")
    if kind == "postgresql" and connection.get("schema"):
        parameters.setdefault("currentSchema", connection["schema"])
    query = _joined(parameters, "&")
    return f"jdbc:{kind}://{host}:{port}/{database}" + (f"?{query}" if query else "")


def jdbc_options(kind: str, connection: dict, session: Sequence[str] = ()) -> dict[str, str]:
    """Spark reader and writer options of a connection."""
    kind = kind.lower()
    options = {
        "url": connection.get("url") or jdbc_url(kind, connection),
        "driver": connection.get("driver") or DRIVERS[kind],
        "fetchsize": str(FETCH_SIZE.get(kind, DEFAULT_FETCH_SIZE)),
        "batchsize": str(FETCH_SIZE.get(kind, DEFAULT_FETCH_SIZE)),
    }
    user = connection.get("username") or connection.get("accessId")
    password = connection.get("password") or connection.get("accessKey")
    if user:
        options["user"] = user
    if password:
        options["password"] = password
    if session:
        options["sessionInitStatement"] = "; ".join(s.rstrip("; ") for s in session)
        if kind == "mysql" and len(session) > 1:
            # Spark runs the list as one statement, which this driver takes only when told so.
            options["allowMultiQueries"] = "true"
    return options


def relation(table: str | None, query: str | None, columns: Sequence[str] | None, where: str | None) -> str:
    """Subquery handed to the database: a query wins over a table."""
    source = f"({query}) t" if query and query.strip() else table
    if not source:
        raise ValueError("a table or a query is needed")
    condition = clean_where(where)
    text = f"select {', '.join(columns) if columns else '*'} from {source}"
    return f"({text}{' where ' + condition if condition else ''}) src"


def read_jdbc(
    spark: SparkSession,
    options: dict[str, str],
    table: str | None = None,
    query: str | None = None,
    columns: Sequence[str] | None = None,
    where: str | None = None,
    split_key: str | None = None,
    splits: int = 1,
    min_step: int = 0,
) -> DataFrame:
    """Scan a database; with ``split_key`` one partition per key range plus null keys.

    The filter is part of the subquery, so the database applies it; the bounds
    are asked of the database with one aggregate.
    """
    scan = relation(table, query, columns, where)
    if not split_key or splits <= 1:
        return spark.read.format("jdbc").options(**options, dbtable=scan).load()
    bounds = relation(table, query, [f"min({split_key}) lo", f"max({split_key}) hi"], None)
    row = spark.read.format("jdbc").options(**options, dbtable=bounds).load().head()
    if row is None or row[0] is None or isinstance(row[0], str):
        return spark.read.format("jdbc").options(**options, dbtable=scan).load()
    ranges = split_ranges(int(row[0]), int(row[1]), splits, min_step)
    wanted = columns if not columns or split_key in columns else [*columns, split_key]
    properties = {k: v for k, v in options.items() if k != "url"}
    parts = spark.read.jdbc(
        options["url"],
        relation(table, query, wanted, where),
        predicates=range_predicates(split_key, ranges),
        properties=properties,
    )
    return parts.select(*columns) if columns and wanted is not columns else parts


def primary_key(
    spark: SparkSession, options: dict[str, str], kind: str, table: str, database: str | None
) -> list[str]:
    """Primary key columns of a table, in order, as its database lists them."""
    schema, _, name = table.rpartition(".")
    schema = schema or (database if kind == "mysql" else "public")
    if kind not in ("mysql", "postgresql"):
        return []
    test = "c.constraint_name = 'PRIMARY'" if kind == "mysql" else "c.constraint_type = 'PRIMARY KEY'"
    query = (
        "select k.column_name as name, k.ordinal_position as place"
        " from information_schema.table_constraints c join information_schema.key_column_usage k"
        " on c.constraint_name = k.constraint_name and c.table_schema = k.table_schema"
        f" and c.table_name = k.table_name where {test}"
        f" and k.table_schema = '{schema}' and k.table_name = '{name}'"
    )
    rows = spark.read.format("jdbc").options(**options, query=query).load()
    return [r[0] for r in rows.orderBy("place").collect()]
