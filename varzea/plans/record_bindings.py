"""Records of the platform over customers and orders. The expressions are read by both engines, so a query's SQL starts from the
same rows and restates the operator alone."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from varzea.plans.bindings import table

NOW = "TIMESTAMP '2024-01-31 00:00:00'"

#: column: expression over customer; ids from 1 on, so every remainder occurs and many columns are null in some rows
RECORD = {
    "id": "c_custkey",
    "uf": "CASE c_nationkey % 5 WHEN 0 THEN 'BA' WHEN 1 THEN 'SP' WHEN 2 THEN 'RJ' WHEN 3 THEN 'MG' ELSE 'PE' END",
    "entity_type": "CASE WHEN c_custkey % 5 = 0 THEN 'destination' ELSE 'attraction' END",
    "source_ref": "concat(CASE c_custkey % 3 WHEN 0 THEN 'mtur' WHEN 1 THEN 'tripadvisor' ELSE 'places' END, ':', CASE c_nationkey % 5 WHEN 0 THEN 'BA' WHEN 1 THEN 'SP' WHEN 2 THEN 'RJ' WHEN 3 THEN 'MG' ELSE 'PE' END, ':', CAST(c_custkey AS STRING))",
    "name": "CASE WHEN c_custkey % 13 <> 0 THEN c_name END",
    "routing": "CASE c_custkey % 4 WHEN 0 THEN 'mar' WHEN 1 THEN 'dlq' WHEN 2 THEN 'dlq' ELSE 'descarte' END",
    "sub_state": "CASE c_custkey % 6 WHEN 0 THEN 'awaiting' WHEN 1 THEN 'whatsapp_in_progress' WHEN 2 THEN 'whatsapp_in_progress' WHEN 3 THEN 'approved' END",
    "score": "CASE WHEN c_custkey % 11 <> 0 THEN CAST(c_custkey % 101 AS DOUBLE) END",
    "phone": "CASE c_custkey % 4 WHEN 0 THEN concat('+55739', lpad(CAST(c_custkey AS STRING), 8, '0')) WHEN 1 THEN concat('+55733', lpad(CAST(c_custkey AS STRING), 7, '0')) WHEN 2 THEN ' ' END",
    "owner_phone": "CASE WHEN c_custkey % 9 = 0 THEN concat('+55119', lpad(CAST(c_custkey AS STRING), 8, '0')) END",
    "website": "CASE WHEN c_custkey % 4 IN (0, 2) THEN concat('https://site', CAST(c_custkey AS STRING)) END",
    "municipio": "CASE WHEN c_custkey % 7 <> 0 THEN concat('Cidade ', CAST(c_nationkey AS STRING)) END",
    "municipio_id": "CASE WHEN c_custkey % 7 <> 0 THEN CAST(2900000 + c_nationkey AS STRING) END",
    "ibge_code": "CASE WHEN c_custkey % 8 = 0 THEN CAST(3500000 + c_nationkey AS STRING) END",
    "tipo": "CASE WHEN c_custkey % 3 = 0 THEN 'praia' WHEN c_custkey % 3 = 1 THEN '' END",
    "parent_source_ref": "CASE WHEN c_custkey % 2 = 0 THEN concat('ibge:', 'BA', ':', CAST(2900000 + c_nationkey AS STRING)) END",
    "lat": "CASE WHEN c_custkey % 10 <> 3 THEN CAST(c_nationkey AS DOUBLE) - 20.1234567D0 END",
    "lon": "CASE WHEN c_custkey % 10 <> 4 THEN CAST(c_nationkey AS DOUBLE) - 50.7654321D0 END",
    "place_id": "CASE WHEN c_custkey % 3 <> 2 THEN concat('pl', CAST(c_custkey AS STRING)) END",
    "status": "CASE c_custkey % 9 WHEN 0 THEN 'CLOSED_PERMANENTLY' WHEN 1 THEN 'CLOSED_TEMPORARILY' WHEN 2 THEN 'OPERATIONAL' WHEN 3 THEN 'OPERATIONAL' END",
    "price_level": "CASE c_custkey % 4 WHEN 0 THEN 'PRICE_LEVEL_FREE' WHEN 1 THEN 'PRICE_LEVEL_MODERATE' WHEN 2 THEN 'other' END",
    "template": "CASE WHEN c_custkey % 12 = 5 THEN 'old' ELSE 'hello' END",
    "body": "CASE WHEN c_custkey % 14 = 5 THEN 'hi' ELSE 'hi from Norteia' END",
    "window_open": "CASE c_custkey % 15 WHEN 1 THEN false WHEN 2 THEN true END",
    "batch_id": "CASE c_custkey % 6 WHEN 1 THEN 'claiming' WHEN 2 THEN 'b2' WHEN 3 THEN 'b3' WHEN 4 THEN 'ambiguous' END",
    "description": "CASE WHEN c_custkey % 10 = 0 THEN 'text' END",
    "attempts": "CASE WHEN c_custkey % 3 <> 0 THEN CAST(c_custkey % 5 AS INT) END",
    "expiries": "CASE WHEN c_custkey % 4 <> 0 THEN CAST(c_custkey % 3 AS INT) END",
    "origin": "CAST(c_custkey % 101 AS DOUBLE)",
    "completeness": "CAST((c_custkey * 7) % 101 AS DOUBLE)",
    "corroboration": "CAST((c_custkey * 3) % 101 AS DOUBLE)",
    "recency": "CAST(CASE c_custkey % 3 WHEN 0 THEN 100 WHEN 1 THEN 40 ELSE 0 END AS DOUBLE)",
    "human": "CAST(CASE WHEN c_custkey % 4 = 0 THEN 100 ELSE 0 END AS DOUBLE)",
}
#: days since the newest review, null where there is none
AGE = "CASE WHEN c_custkey % 6 <> 0 THEN CAST(c_custkey % 200 AS INT) END"
KIND = "CASE WHEN c_custkey % 5 = 0 THEN 'destino' ELSE 'atrativo' END"

SCORE = "floor((origin * 30.0 / 100.0 + completeness * 20.0 / 100.0 + corroboration * 20.0 / 100.0 + recency * 15.0 / 100.0 + human * 15.0 / 100.0) * 100 + 0.5) / 100"


def _for_duckdb(x: str) -> str:
    return x.replace("D0", "::DOUBLE")


def records_sql(*extra: str) -> str:
    """The rows in DuckDB's SQL, with further expressions over customer."""
    return "SELECT " + ", ".join([f"{_for_duckdb(e)} AS {c}" for c, e in RECORD.items()] + [_for_duckdb(x) for x in extra]) + ", " + f"{NOW} - to_days(CAST({AGE} AS INT)) AS newest_review FROM customer"


def records(spark: SparkSession, sf_dir: str, *extra: str) -> DataFrame:
    made = [f"{e.replace('D0', 'D')} AS {c}" for c, e in RECORD.items()] + [x.replace("D0", "D") for x in extra]
    return table(spark, sf_dir, "customer").selectExpr(*made, f"TIMESTAMP_NTZ '2024-01-31 00:00:00' - make_interval(0, 0, 0, {AGE}) AS newest_review")
