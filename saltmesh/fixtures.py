"""Deterministic mesh, series and ledger tables derived from the driver's tables, in Spark SQL and in DuckDB SQL."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

VIEWS: dict[str, str] = {
    # Strips of 36 nodes and 50 triangles, as many as there are orders for. The series below have 300 hours, and a strip for every 15,000 orders.
    "fx_node": """
        SELECT n + 1 AS node, CAST(-152 AS DOUBLE) + ((n % 36) % 6) * 1e-2 + ((n div 36) % 500) * 7e-2 AS lon_node,
               CAST(59 AS DOUBLE) + ((n % 36) div 6) * 1e-2 + (((n div 36) div 500) % 400) * 7e-2 AS lat_node
        FROM (SELECT DISTINCT o_orderkey AS n FROM orders) a""",
    "fx_face": """
        SELECT face, CASE WHEN up = 0 THEN b0 ELSE b0 + 1 END AS n1, CASE WHEN up = 0 THEN b0 + 1 ELSE b0 + 7 END AS n2, b0 + 6 AS n3,
               CAST(20 + (face * 7) % 13 AS DOUBLE) AS h_center
        FROM (SELECT f AS face, f % 2 AS up, (f div 50) * 36 + (((f % 50) div 2) div 5) * 6 + ((f % 50) div 2) % 5 + 1 AS b0
              FROM (SELECT DISTINCT o_orderkey AS f FROM orders) a) b""",
    "fx_sigma": "SELECT r_regionkey AS sigma_layer, -(r_regionkey + 5e-1) / 4e0 AS sigma FROM region WHERE r_regionkey < 4",
    "fx_velocity": """
        SELECT o.o_orderkey % 50 + (o.o_orderkey div 15000) * 50 AS face, (o.o_orderkey div 50) % 300 AS t,
               (TIMESTAMP_NTZ '2005-01-01 00:00:00' + make_dt_interval(0, CAST((o.o_orderkey div 50) % 300 AS INT))) AS time,
               s.r_regionkey AS sigma_layer,
               ((CAST(ROUND(o.o_totalprice * 100) AS BIGINT) * (s.r_regionkey + 3)) % 4001 - 2000) / 1e3 AS u,
               ((CAST(ROUND(o.o_totalprice * 100) AS BIGINT) * (s.r_regionkey + 7)) % 4003 - 2001) / 1e3 AS v
        FROM orders o CROSS JOIN (SELECT r_regionkey FROM region WHERE r_regionkey < 4) s""",
    "fx_zeta": """
        SELECT n.t, (TIMESTAMP_NTZ '2005-01-01 00:00:00' + make_dt_interval(0, CAST(n.t AS INT))) AS time, n.node,
               (1e0 + (n.node % 5) * 1e-1) * (ABS((n.t + n.node % 3) % 12 - 6) - 3) / 3e0 + ((n.t * 7) % 24) / 2.4e2 AS zeta
        FROM (SELECT (o_orderkey div 50) % 300 AS t, (o_orderkey div 15000) * 36 + o_orderkey % 50 + 1 AS node FROM orders WHERE o_orderkey % 50 < 36) n""",
    "fx_points": """
        SELECT c_custkey AS face, CAST(59 AS DOUBLE) + ((c_custkey * 7919) % 100003) * 1e-5 AS lat,
               CAST(-152 AS DOUBLE) - ((c_custkey * 104729) % 99991) * 1e-5 AS lon
        FROM customer""",
    "fx_query": """
        SELECT s_suppkey AS qid, CAST(59 AS DOUBLE) + ((s_suppkey * 15485863) % 99989) * 1e-5 AS lat,
               CAST(-152 AS DOUBLE) - ((s_suppkey * 32452843) % 99971) * 1e-5 AS lon
        FROM supplier""",
    "fx_ledger": """
        SELECT o_orderkey AS file_index, concat('loc', CAST(o_custkey % 6 AS STRING), '/f', CAST(o_orderkey AS STRING), '.parquet') AS s3_destination,
               CAST(ROUND(o_totalprice) AS BIGINT) AS file_size_bytes,
               CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'pending' ELSE 'failed' END AS upload_status
        FROM orders""",
    # Layers and columns derived from the above, as the operators should give them.
    "fx_layer": """
        SELECT face, t, time, sigma_layer, u, v, sqrt(u * u + v * v) AS speed FROM fx_velocity""",
    "fx_zeta_center": """
        SELECT c.face, z.t, z.time, sum(z.zeta) / 3e0 AS zeta_center
        FROM (SELECT face, n1 AS node FROM fx_face UNION ALL SELECT face, n2 FROM fx_face UNION ALL SELECT face, n3 FROM fx_face) c
        JOIN fx_zeta z ON z.node = c.node GROUP BY c.face, z.t, z.time""",
}

NEEDS = {"fx_layer": ["fx_velocity"], "fx_zeta_center": ["fx_face", "fx_zeta"]}


def _needed(names: list[str]) -> list[str]:
    out: list[str] = []
    for n in names:
        for m in [*NEEDS.get(n, []), n]:
            if m not in out:
                out.append(m)
    return out


class Fixtures:
    """Tables of sf_dir and the views over them, as DataFrames."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def __getattr__(self, name: str) -> DataFrame:
        view = f"fx_{name}"
        if view not in VIEWS:
            raise AttributeError(name)
        text = VIEWS[view]
        frames: dict[str, DataFrame] = {}
        for other in NEEDS.get(view, []):
            frames[other] = getattr(self, other.removeprefix("fx_"))
        for t in TABLES:
            if re.search(rf"(FROM|JOIN) {t}\b", text):
                frames[t] = self.table(t)
        for n in frames:
            text = re.sub(rf"(FROM|JOIN) {n}\b", rf"\1 {{{n}}}", text)
        return self.spark.sql(text, **frames)


def duck(text: str) -> str:
    """A view's text for DuckDB."""
    text = text.replace(" div ", " // ").replace("TIMESTAMP_NTZ '", "TIMESTAMP '").replace("AS STRING)", "AS VARCHAR)")
    return text.replace("make_dt_interval(0, ", "to_hours(")


def with_views(sql: str) -> str:
    """DuckDB SQL with the views that it names in front."""
    names = _needed([v for v in VIEWS if re.search(rf"\b{v}\b", sql)])
    ctes = [f"{n} AS ({duck(VIEWS[n]).strip()})" for n in names]
    body = sql.strip()
    if body.upper().startswith("WITH "):
        body = body[5:].lstrip()
        head = "WITH RECURSIVE" if body.upper().startswith("RECURSIVE ") else "WITH"
        body = body.removeprefix("RECURSIVE ")
        return f"{head} {', '.join(ctes)}, {body}" if ctes else sql
    return f"WITH {', '.join(ctes)} {body}" if ctes else sql
