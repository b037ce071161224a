"""Pieces that the SQL twins share."""

from __future__ import annotations


def hav(a: str, b: str, c: str, d: str) -> str:
    """Metres between (lng a, lat b) and (lng c, lat d)."""
    h = f"(pow(sin(radians(({d})-({b}))/2),2)+cos(radians({b}))*cos(radians({d}))*pow(sin(radians(({c})-({a}))/2),2))"
    return f"(2*6371000.0*atan2(sqrt({h}),sqrt(greatest(1-{h},0.0))))"


def bear(a: str, b: str, c: str, d: str) -> str:
    y = f"sin(radians(({c})-({a})))*cos(radians({d}))"
    x = f"(cos(radians({b}))*sin(radians({d}))-sin(radians({b}))*cos(radians({d}))*cos(radians(({c})-({a}))))"
    return f"(((degrees(atan2({y},{x}))+360.0)%360.0+360.0)%360.0)"


def turn(a: str, b: str) -> str:
    d = f"(abs(({a})-({b}))%360.0)"
    return f"least({d},360.0-{d})"


def up(x: str, digits: int = 0) -> str:
    k = f"1e{digits}"
    return f"(floor(({x})*{k}+0.5)/{k})"


#: Tracks made of the events table: steps of whole 1e-5 degrees, so that every engine sums them exactly.
TRACKS = """tr0 AS (SELECT user_id AS track, event_id, ts, ((event_id*7919)%401-200)*(CASE WHEN event_id%41=0 THEN 20 ELSE 1 END) AS dx,
  ((event_id*104729)%401-200)*(CASE WHEN event_id%41=0 THEN 20 ELSE 1 END) AS dy FROM events WHERE user_id IS NOT NULL),
tr AS (SELECT track, row_number() OVER w AS ord, -75.7+(sum(dx) OVER (w ROWS UNBOUNDED PRECEDING))::BIGINT/1e5 AS lng,
  45.4+(sum(dy) OVER (w ROWS UNBOUNDED PRECEDING))::BIGINT/1e5 AS lat FROM tr0 WINDOW w AS (PARTITION BY track ORDER BY ts, event_id)),
st AS (SELECT *, """ + hav("plng", "plat", "lng", "lat") + """ AS step_m FROM (SELECT *, lag(lng) OVER w AS plng, lag(lat) OVER w AS plat FROM tr WINDOW w AS (PARTITION BY track ORDER BY ord))),
sc AS (SELECT *, coalesce(sum(step_m) OVER (PARTITION BY track ORDER BY ord ROWS UNBOUNDED PRECEDING),0) AS cum_m FROM st),
en AS (SELECT track, count(*) AS n, coalesce(sum(step_m),0) AS length_m, arg_min(lng,ord) AS lng0, arg_min(lat,ord) AS lat0, arg_max(lng,ord) AS lng1, arg_max(lat,ord) AS lat1,
  avg(lng) AS cx, avg(lat) AS cy FROM st GROUP BY track)"""
