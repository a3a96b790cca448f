"""The client tables as views over the test tables, in SQL that both engines read alike."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import DataFrame, SparkSession

AS_OF = dt.date(2001, 8, 2)
BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
               "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

# Place texts as typed by hand, with the names they must become.
CITIES = [
    ("BOGOTA D.C.", "Bogotá"), ("Suba", "Bogotá"), ("Subachoque", "Bogotáchoque"),
    ("medellin - antioquia", "Medellín"), ("Cali (Valle)", "Cali"), ("Cucuta", "Cúcuta"),
    ("CAJICA", "Cajicá"), ("Chia Cundinamarca", "Chía"), ("Zipaquira", "Zipaquira"),
    ("villavicencio meta", "Villavicencio"), ("Sangil", "San Gil"), ("Barrancabermeja", "Barrancabermeja"),
    ("baranquilla", "Barranquilla"), ("Ibague", "Ibagué"), ("Santa Marta", "Santa Marta"),
    ("Bello Antioquia", "Bello"), ("San Andres Isla", "San Andrés"), ("San José", "San Jose"), ("12345", ""),
]
DEPARTMENTS = [
    ("BOYACÁ", "Boyacá"), ("NARIÑO", "Nariño"), ("san andres y providencia", "San Andrés Y Providencia"),
    ("Valle del Cauca", "Valle Del Cauca"),
]


def _values(texts) -> str:
    return "VALUES " + ", ".join(f"({i}, '{text}', '{name}')" for i, (text, name) in enumerate(texts))


VIEWS = {
    "donors": """
SELECT c_custkey AS donor_id,
       CASE WHEN c_custkey % 41 = 0 THEN NULL ELSE CAST((c_custkey * 7) % 100 AS INT) END AS age,
       CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE CAST((c_custkey * 13) % 101 AS DOUBLE) / 4 END AS churn_prob,
       CASE WHEN c_custkey % 19 = 0 THEN NULL ELSE CAST((c_custkey * 29) % 101 AS DOUBLE) / 8 END AS lapsed_prob,
       c_custkey % 10 <> 0 AS is_active,
       CAST(c_custkey % 37 AS INT) AS instalments_paid,
       CAST(c_custkey % 11 AS INT) AS instalments_unpaid,
       c_mktsegment AS gender,
       c_acctbal AS current_amount,
       n.n_name AS department,
       'Campaign ' || CAST(((c_custkey % 31) * (c_custkey % 31)) % 31 AS STRING) AS campaign
FROM customer JOIN nation n ON c_nationkey = n.n_nationkey""",
    "places_city": "SELECT * FROM (" + _values(CITIES) + ") AS p(place_id, city_text, city)",
    "places_department": "SELECT * FROM (" + _values(DEPARTMENTS) + ") AS p(place_id, department_text, department)",
    "donors_raw": """
SELECT CAST(c_custkey AS STRING) AS psn,
       CASE WHEN c_custkey % 29 = 0 THEN 'Nº de error'
            WHEN c_custkey % 31 = 0 THEN NULL
            WHEN c_custkey % 2 = 0 THEN lpad(CAST(day(d) AS STRING), 2, '0') || '/' || lpad(CAST(month(d) AS STRING), 2, '0') || '/' || CAST(year(d) AS STRING)
            ELSE CAST(year(d) AS STRING) || '-' || lpad(CAST(month(d) AS STRING), 2, '0') || '-' || lpad(CAST(day(d) AS STRING), 2, '0') END AS capture_date,
       CASE WHEN c_custkey % 23 = 0 THEN 'mas de 10' WHEN c_custkey % 5 = 0 THEN NULL ELSE CAST(c_custkey % 4 AS STRING) END AS children,
       CASE WHEN c_custkey % 7 = 0 THEN NULL WHEN c_custkey % 3 = 0 THEN 'No' ELSE 'Si' END AS has_children,
       CAST(c_custkey % 900 AS STRING) || ',' || CAST(c_custkey % 10 AS STRING) AS amount_text,
       CAST(c_custkey % 24 AS INT) AS place_id,
       CAST(c_custkey % 5 AS INT) AS department_id
FROM customer JOIN (SELECT o_custkey, CAST(max(o_orderdate) AS DATE) AS d FROM orders GROUP BY o_custkey) o ON c_custkey = o.o_custkey""",
    # every column of the donor file, as text, under this package's names
    "donor_file": """
SELECT CAST(c_custkey AS STRING) AS donor_id,
       CASE WHEN c_custkey % 43 = 0 THEN NULL
            ELSE CAST(1940 + c_custkey % 50 AS STRING) || '-' || lpad(CAST(1 + c_custkey % 12 AS STRING), 2, '0') || '-' || lpad(CAST(1 + c_custkey % 28 AS STRING), 2, '0') END AS birth_date,
       CASE WHEN c_custkey % 31 = 0 THEN NULL
            WHEN c_custkey % 2 = 0 THEN lpad(CAST(month(d) AS STRING), 2, '0') || '/' || lpad(CAST(day(d) AS STRING), 2, '0') || '/' || CAST(year(d) AS STRING)
            ELSE CAST(year(d) AS STRING) || '-' || lpad(CAST(month(d) AS STRING), 2, '0') || '-' || lpad(CAST(day(d) AS STRING), 2, '0') END AS capture_date,
       CASE WHEN c_custkey % 29 = 0 THEN 'Nº de error' WHEN c_custkey % 13 = 0 THEN NULL
            ELSE CAST(1996 + c_custkey % 5 AS STRING) || '-' || CAST(1 + c_custkey % 12 AS STRING) || '-' || CAST(1 + c_custkey % 28 AS STRING) END AS payment_anniversary,
       CASE WHEN c_custkey % 41 = 0 THEN NULL ELSE CAST((c_custkey * 7) % 100 AS STRING) END AS age,
       CASE WHEN c_custkey % 23 = 0 THEN 'mas de 10' WHEN c_custkey % 5 = 0 THEN NULL ELSE CAST(c_custkey % 4 AS STRING) END AS children,
       CASE WHEN c_custkey % 7 = 0 THEN NULL WHEN c_custkey % 3 = 0 THEN 'No' ELSE 'Si' END AS has_children,
       CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE CAST((c_custkey * 13) % 101 AS STRING) END AS churn_prob,
       CASE WHEN c_custkey % 19 = 0 THEN NULL ELSE CAST((c_custkey * 29) % 101 AS STRING) || '.5' END AS lapsed_prob,
       CASE WHEN c_custkey % 10 = 0 THEN '0' ELSE '1' END AS is_active,
       'Persona' AS contact_type,
       c_mktsegment AS gender,
       CASE CAST(c_custkey % 4 AS INT) WHEN 0 THEN 'Soltero' WHEN 1 THEN 'Casado' WHEN 2 THEN 'Viudo' ELSE NULL END AS marital_status,
       CASE CAST(c_custkey % 3 AS INT) WHEN 0 THEN 'Docente' WHEN 1 THEN 'Empleado' ELSE 'Otro' END AS occupation,
       'RFM ' || CAST(c_custkey % 6 AS STRING) AS rfm_segment,
       CAST(c_custkey % 37 AS STRING) AS instalments_paid,
       CAST(c_custkey % 11 AS STRING) || '.0' AS instalments_unpaid,
       'Campaign ' || CAST(c_custkey % 31 AS STRING) AS campaign,
       pc.city_text AS city,
       pd.department_text AS department,
       CAST(c_custkey % 900 AS STRING) || '.25' AS current_amount
FROM customer
LEFT JOIN (SELECT o_custkey, CAST(max(o_orderdate) AS DATE) AS d FROM orders GROUP BY o_custkey) o ON c_custkey = o.o_custkey
LEFT JOIN places_city pc ON c_custkey % 24 = pc.place_id
LEFT JOIN places_department pd ON c_custkey % 5 = pd.place_id""",
    "transactions": """
SELECT o_orderkey AS tx_id, o_custkey AS donor_id, CAST(o_orderdate AS DATE) AS tx_date, o_totalprice AS amount,
       CASE o_orderstatus WHEN 'F' THEN 'Cobrada' WHEN 'P' THEN 'Perdida' ELSE 'Eliminada' END AS stage,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'DI - Regular' WHEN '2-HIGH' THEN 'PF - Padrinazgo familiar'
            WHEN '3-MEDIUM' THEN 'PI - Padrinazgo individual' WHEN '4-NOT SPECIFIED' THEN 'Unica' ELSE 'Evento' END AS record_type
FROM orders""",
    # every column of the transaction file, as text
    "transaction_file": """
SELECT CAST(o_custkey AS STRING) AS donor_id,
       CASE WHEN o_orderkey % 101 = 0 THEN 'sin fecha'
            ELSE lpad(CAST(day(o_orderdate) AS STRING), 2, '0') || '/' || lpad(CAST(month(o_orderdate) AS STRING), 2, '0') || '/' || CAST(year(o_orderdate) AS STRING) END AS tx_date,
       CASE WHEN o_orderkey % 2 = 0 THEN CAST(year(o_orderdate) AS STRING) || '-' || CAST(month(o_orderdate) AS STRING) || '-' || CAST(day(o_orderdate) AS STRING)
            ELSE CAST(day(o_orderdate) AS STRING) || '/' || CAST(month(o_orderdate) AS STRING) || '/' || CAST(year(o_orderdate) AS STRING) END AS booking_date,
       CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE '05/' || lpad(CAST(month(o_orderdate) AS STRING), 2, '0') || '/1995' END AS first_charge,
       CASE WHEN o_orderkey % 11 = 0 THEN '31/02/2001' ELSE '2001-08-01' END AS last_donation,
       CASE WHEN o_orderkey % 97 = 0 THEN '1.234,56' ELSE CAST(o_orderkey % 90000 AS STRING) || ',' || CAST(o_orderkey % 10 AS STRING) END AS amount,
       CASE o_orderstatus WHEN 'F' THEN 'Cobrada' WHEN 'P' THEN 'Perdida' ELSE 'Eliminada' END AS stage,
       o_orderpriority AS campaign_channel,
       CASE WHEN o_orderkey % 3 = 0 THEN 'Activo' ELSE NULL END AS status,
       'Mensual' AS commitment,
       CASE WHEN o_orderkey % 4 = 0 THEN 'Tarjeta' ELSE 'Debito' END AS payment_method,
       'DI - Regular' AS record_type
FROM orders""",
    "cancellation_file": """
SELECT CAST(o_custkey AS STRING) AS donor_id,
       CASE WHEN o_custkey % 30 = 0 THEN 'pendiente'
            ELSE lpad(CAST(day(max(o_orderdate)) AS STRING), 2, '0') || '/' || lpad(CAST(month(max(o_orderdate)) AS STRING), 2, '0') || '/' || CAST(year(max(o_orderdate)) AS STRING) END AS cancel_date,
       CAST(year(min(o_orderdate)) AS STRING) || '-' || CAST(month(min(o_orderdate)) AS STRING) || '-' || CAST(day(min(o_orderdate)) AS STRING) AS first_charge,
       CASE WHEN o_custkey % 20 = 0 THEN NULL ELSE '01/08/2001' END AS last_donation,
       CASE CAST(o_custkey % 3 AS INT) WHEN 0 THEN 'economic' WHEN 1 THEN 'contact' ELSE 'other' END AS reason,
       'Baja' AS status
FROM orders GROUP BY o_custkey""",
    "inflation_m": """
SELECT CAST(y * 100 + m AS STRING) AS period, 2 + CAST((y * 12 + m) % 7 AS DOUBLE) / 2 AS pct
FROM (SELECT DISTINCT CAST(year(o_orderdate) AS INT) AS y, CAST(month(o_orderdate) AS INT) AS m FROM orders) a""",
    "requests": """
SELECT event_id AS request_id,
       CASE WHEN event_id % 97 = 0 THEN 'n/a' ELSE CAST(CAST(event_id % 400 AS INT) AS STRING) END AS churn,
       CASE WHEN event_id % 89 = 0 THEN NULL ELSE CAST(CAST(1000 * (event_id % 5000) AS INT) AS STRING) END AS dltv,
       CASE WHEN event_id % 4 = 0 THEN '0.25' WHEN event_id % 4 = 1 THEN '0.5' ELSE '1' END AS effectiveness
FROM events""",
}


def _names_in(sql: str, names) -> list[str]:
    return [n for n in names if re.search(rf"\b{n}\b", sql)]


def _needed(sql: str) -> list[str]:
    """Views used by ``sql``, the ones they use first."""
    order: list[str] = []
    for name in _names_in(sql, VIEWS):
        for inner in [*_needed(VIEWS[name]), name]:
            if inner not in order:
                order.append(inner)
    return order


def with_views(sql: str) -> str:
    """The statement with the views it uses as common table expressions, for the oracle."""
    body = sql.strip()
    parts = [f"{name} AS ({VIEWS[name].strip()})" for name in _needed(body)]
    if not parts:
        return body
    if body[:5].upper() == "WITH ":
        body = ", " + body[5:]
        return "WITH " + ",\n".join(parts) + body
    return "WITH " + ",\n".join(parts) + "\n" + body


class Tables:
    """The test tables and views of one folder, by attribute."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name in BASE_TABLES:
            return self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        if name in VIEWS:
            return self.view(name)
        raise AttributeError(name)

    def view(self, name: str, **replace: DataFrame) -> DataFrame:
        """A view, with some of its inputs replaced (by a streaming frame, for example)."""
        text = VIEWS[name]
        inputs = [n for n in (*BASE_TABLES, *VIEWS) if re.search(rf"(FROM|JOIN)\s+{n}\b", text)]
        for n in inputs:
            text = re.sub(rf"\b(FROM|JOIN)(\s+){n}\b", rf"\1\2{{{n}}}", text)
        return self.spark.sql(text, **{n: replace[n] if n in replace else getattr(self, n) for n in inputs})
