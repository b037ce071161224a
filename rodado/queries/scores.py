"""Queries on additive scores, over columns told from the orders and customers."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scores
from ..session import table


def interest(s, d):
    k = F.col("o_orderkey")
    m = lambda n: (k % n).cast("int")
    x = scores.interest(m(11), m(7), m(50).cast("double"), m(101).cast("double"), m(5), m(9), m(4), m(100) / 100, k % 2 == 0, m(6), m(3), m(1500).cast("double"))
    return table(s, d, "orders").select("o_orderkey", F.round(x, 4).alias("interest"))


def path_score(s, d):
    k = F.col("o_orderkey")
    m = lambda n: (k % n).cast("double")
    x = scores.path_score(m(6), m(9000), m(4000), m(3000), m(2500), -m(5), m(100) / 100, (k % 6).cast("int"))
    return table(s, d, "orders").select("o_orderkey", F.round(x, 4).alias("score"))


def zone_interest(s, d):
    k = F.col("c_custkey")
    m = lambda n: (k % n).cast("double")
    x = scores.zone_interest(F.array(m(9), m(7), m(5)), F.array(k % 3, k % 2, k % 4))
    return table(s, d, "customer").select("c_custkey", F.round(x, 4).alias("interest"), F.round(scores.edge_free_share(F.array(k % 2, k % 3, k % 5)), 4).alias("free"))


QUERIES = {"q_interest": interest, "q_path_score": path_score, "q_zone_interest": zone_interest}
_D = lambda n: f"(o_orderkey%{n})::DOUBLE"
SQL = {
    "q_interest": f"""SELECT o_orderkey, round((o_orderkey%11+o_orderkey%7)*1.5::DOUBLE + 2*(CASE WHEN {_D(50)} BETWEEN 5 AND 30 THEN 5 WHEN {_D(50)} BETWEEN 2 AND 40 THEN 3 ELSE 0 END) + 3*least({_D(101)}/20,5.0::DOUBLE) + o_orderkey%5 + least(o_orderkey%9,5)
+ (o_orderkey%4)*1.5::DOUBLE + least({_D(100)}/100*20,6.0::DOUBLE) + (CASE WHEN o_orderkey%2=0 THEN 5 ELSE 0 END) + (CASE WHEN o_orderkey%6>=4 THEN 6 WHEN o_orderkey%6>=3 THEN 3 ELSE 0 END) + 2*(o_orderkey%3)
- (CASE WHEN {_D(101)}<70 THEN 5 WHEN {_D(101)}<80 THEN 2 ELSE 0 END) - (CASE WHEN {_D(1500)}>1000 THEN 3 WHEN {_D(1500)}>500 THEN 1 ELSE 0 END), 4) AS interest FROM orders""",
    "q_path_score": f"""WITH a AS (SELECT o_orderkey, {_D(9000)}/nullif({_D(4000)},0) AS r, ({_D(3000)}+{_D(2500)})/nullif({_D(4000)},0) AS p FROM orders),
b AS (SELECT *, coalesce(CASE WHEN r BETWEEN 0.5 AND 1.5 THEN 5 WHEN r BETWEEN 0.3 AND 2 THEN 3 WHEN r BETWEEN 0.2 AND 3 THEN 1 ELSE 0 END,0) AS direct,
(CASE WHEN p IS NULL THEN 0 WHEN p<=0.3 THEN 10 WHEN p<=0.6 THEN 8 WHEN p<=1 THEN 6 WHEN p<=1.5 THEN 4 WHEN p<=2 THEN 2 ELSE 0 END)::DOUBLE AS al FROM a)
SELECT o_orderkey, round({_D(6)}*2*(al/10) + direct + al + greatest(-{_D(5)},-3)*(1-al/10) + least({_D(100)}/100*2,2.0::DOUBLE)*(al/10) + least(o_orderkey%6,3), 4) AS score FROM b""",
    "q_zone_interest": """SELECT c_custkey, round((c_custkey%9)::DOUBLE + 0.5::DOUBLE*(c_custkey%7) + (c_custkey%5) + least(2*(len(list_distinct([c_custkey%3, c_custkey%2, c_custkey%4]))-1),6), 4) AS interest,
round(len(list_filter([c_custkey%2, c_custkey%3, c_custkey%5], lambda c: c=0))/3.0::DOUBLE, 4) AS free FROM customer""",
}
