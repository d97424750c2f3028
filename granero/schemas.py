"""Declared schemas: scans never infer."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


_I, _L, _D, _S, _TS = T.IntegerType(), T.LongType(), T.DoubleType(), T.StringType(), T.TimestampType()

TABLES: dict[str, T.StructType] = {
    "region": _schema(r_regionkey=_I, r_name=_S),
    "nation": _schema(n_nationkey=_I, n_name=_S, n_regionkey=_I),
    "customer": _schema(c_custkey=_L, c_name=_S, c_nationkey=_I, c_acctbal=_D, c_mktsegment=_S),
    "supplier": _schema(s_suppkey=_L, s_name=_S, s_nationkey=_I, s_acctbal=_D),
    "part": _schema(p_partkey=_L, p_name=_S, p_brand=_S, p_type=_S, p_size=_I, p_retailprice=_D),
    "orders": _schema(
        o_orderkey=_L, o_custkey=_L, o_orderstatus=_S, o_totalprice=_D, o_orderdate=_TS, o_orderpriority=_S
    ),
    "lineitem": _schema(
        l_orderkey=_L, l_partkey=_L, l_suppkey=_L, l_linenumber=_I, l_quantity=_D, l_extendedprice=_D,
        l_discount=_D, l_tax=_D, l_returnflag=_S, l_linestatus=_S, l_shipdate=_TS,
    ),
    "events": _schema(event_id=_L, ts=_TS, user_id=_L, event_type=_S, value=_D, props=_S),
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{folder}/{name}.parquet")
