"""Queries on tracks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import tracks as T
from ._sql import TRACKS, bear, hav, turn, up
from .views import event_tracks

W = "WINDOW w AS (PARTITION BY track ORDER BY ord)"
JOINED = "sc JOIN en USING (track)"
QUERIES, SQL = {}, {}


def _add(name, make, sql=None):
    QUERIES[name] = make
    if sql:
        SQL[name] = f"WITH RECURSIVE {sql}" if sql.startswith(TRACKS) else f"WITH {TRACKS} {sql}" if not sql.lstrip().startswith(",") else f"WITH {TRACKS}{sql}"


def r3(df, *cols):
    return df.withColumns({c: F.round(c, 3) for c in cols})


_add("q_track_length", lambda s, d: r3(T.ends(event_tracks(s, d)), "length_m", "clng", "clat").select("track", "points", "length_m", "min_lng", "max_lng", "min_lat", "max_lat", "clng", "clat"),
     "SELECT track, count(*) AS points, round(coalesce(sum(step_m),0),3) AS length_m, min(lng) AS min_lng, max(lng) AS max_lng, min(lat) AS min_lat, max(lat) AS max_lat, round(avg(lng),3) AS clng, round(avg(lat),3) AS clat FROM st GROUP BY track")
_add("q_jumps", lambda s, d: T.jumps(event_tracks(s, d)),
     f"SELECT track, count(*) FILTER (step_m>500) AS over_500, count(*) FILTER (step_m>1000) AS over_1k, count(*) FILTER (step_m>2000) AS over_2k, coalesce({up('max(step_m)')},0)::BIGINT AS worst_m FROM st GROUP BY track")
_add("q_density", lambda s, d: T.density(event_tracks(s, d)),
     f"SELECT track, n AS points, {up('length_m/1000',1)} AS dist_km, (CASE WHEN length_m>0 THEN {up('n/(length_m/1000)')} ELSE 0 END)::BIGINT AS points_per_km FROM en")

_TURNS = f""", b AS (SELECT *, {bear('plng','plat','lng','lat')} AS b FROM st WHERE step_m>=30), t AS (SELECT *, lag(b) OVER w AS pb FROM b {W}),
turns AS (SELECT track, count(*) FILTER ({turn('pb','b')}>120 AND step_m>50) AS sharp_turns FROM t GROUP BY track)"""
_add("q_turns", lambda s, d: T.sharp_turns(event_tracks(s, d)), _TURNS + " SELECT * FROM turns")
_CROW = hav("lng0", "lat0", "lng1", "lat1")
_PROJ = "(((lng-lng0)*(lng1-lng0)+(lat-lat0)*(lat1-lat0))/sqrt((lng1-lng0)*(lng1-lng0)+(lat1-lat0)*(lat1-lat0))*111320.0)"
_ONE = f""", p AS (SELECT track, ord, CASE WHEN (lng1-lng0)*(lng1-lng0)+(lat1-lat0)*(lat1-lat0)>1e-12 THEN {_PROJ} END AS p FROM {JOINED} WHERE step_m>=30 AND {_CROW}>=2000),
pf AS (SELECT *, max(p) OVER (PARTITION BY track ORDER BY ord ROWS UNBOUNDED PRECEDING) AS far FROM p),
one AS (SELECT track, count(*) FILTER (far-p>200) AS walkbacks FROM pf GROUP BY track)"""
_add("q_walkback", lambda s, d: T.walkbacks_one_way(event_tracks(s, d)), _ONE + " SELECT * FROM one")
_ANG = f""", zz0 AS (SELECT *, row_number() OVER w - 1 AS i FROM {JOINED} {W}),
zz1 AS (SELECT *, degrees(atan2(lng-cx, lat-cy)) AS a FROM zz0 WHERE i % greatest(n//100,1) = 0),
zz2 AS (SELECT *, a - lag(a) OVER w AS d0 FROM zz1 {W}),
zz AS (SELECT *, CASE WHEN d0>180 THEN d0-360 WHEN d0<-180 THEN d0+360 ELSE d0 END AS delta FROM zz2)"""
_LOOPS = _ANG + f""", ld AS (SELECT *, CASE WHEN abs(delta)>5 THEN sign(delta) END AS dir FROM zz WHERE {_CROW}<2000),
lb AS (SELECT *, last_value(dir IGNORE NULLS) OVER (PARTITION BY track ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM ld),
lo AS (SELECT track, count(*) FILTER (dir<>before AND abs(delta)>15) AS walkbacks FROM lb GROUP BY track)"""
_add("q_walkback_loop", lambda s, d: T.walkbacks_loop(event_tracks(s, d)), _LOOPS + " SELECT * FROM lo")
_SMOOTH = _TURNS + _ONE + _LOOPS + f""", sm AS (SELECT track, (CASE WHEN n<3 THEN 100 ELSE {up('greatest(100-coalesce(sharp_turns,0)/greatest(n-1,1)*2000,0.0)')} END)::BIGINT AS smoothness,
(CASE WHEN n<3 THEN 0 ELSE coalesce(one.walkbacks, lo.walkbacks, 0) END)::BIGINT AS walkbacks, (CASE WHEN n<3 THEN 0 ELSE coalesce(sharp_turns,0) END)::BIGINT AS sharp_turns
FROM en LEFT JOIN turns USING (track) LEFT JOIN one USING (track) LEFT JOIN lo USING (track))"""
_add("q_smoothness", lambda s, d: T.smoothness(event_tracks(s, d)), _SMOOTH + " SELECT * FROM sm")
_INTER = f""", ib AS (SELECT *, {bear('plng','plat','lng','lat')} AS b FROM st), ic AS (SELECT *, lag(step_m) OVER w AS pm, lag(b) OVER w AS pb FROM ib {W}),
im AS (SELECT *, coalesce(step_m>40 AND step_m<60 AND pm>40 AND pm<60 AND {turn('pb','b')}<2, false) AS made FROM ic),
io AS (SELECT *, made AND NOT coalesce(lag(made) OVER w, false) AS starts FROM im {W}),
ip AS (SELECT track, (CASE WHEN sum(step_m)>0 THEN {up('(1-coalesce(sum(step_m) FILTER (made),0)/sum(step_m))*100')} ELSE 100 END)::BIGINT AS real_pct, count(*) FILTER (starts) AS runs,
{up('coalesce(sum(step_m) FILTER (made),0)')}::BIGINT AS interpolated_m FROM io GROUP BY track)"""
_add("q_interpolated", lambda s, d: T.interpolated(event_tracks(s, d)), _INTER + " SELECT * FROM ip")
_RIDE = _ANG.replace("zz", "yy") + f""", rl AS (SELECT track, n, {_CROW} < greatest(2000, length_m*0.15) AS loop FROM en),
rp AS (SELECT sc.track, ord, step_m, coalesce(CASE WHEN (lng1-lng0)*(lng1-lng0)+(lat1-lat0)*(lat1-lat0)>1e-12 THEN {_PROJ} END, 0) AS p FROM {JOINED} JOIN rl ON rl.track=sc.track WHERE NOT loop),
rq AS (SELECT *, p < lag(p) OVER w AS back FROM rp {W}),
r1 AS (SELECT rq.track, any_value(n) AS n, {up('greatest(1-coalesce(sum(step_m) FILTER (back),0)*2/any_value(length_m),0.0)*100')} AS r, {up('coalesce(sum(step_m) FILTER (back),0)')} AS w FROM rq JOIN en USING (track) GROUP BY rq.track),
rd AS (SELECT yy.*, CASE WHEN sum(CASE WHEN delta>0 THEN 1 WHEN delta IS NOT NULL THEN -1 END) OVER (PARTITION BY yy.track)>=0 THEN 1 ELSE -1 END AS sense FROM yy JOIN rl ON rl.track=yy.track WHERE loop),
re AS (SELECT track, any_value(n) AS n, any_value(length_m) AS t, coalesce(sum(abs(delta)) FILTER (abs(delta)>2 AND sign(delta)=sense),0) AS f, coalesce(sum(abs(delta)) FILTER (abs(delta)>2 AND sign(delta)<>sense),0) AS b FROM rd GROUP BY track),
r2 AS (SELECT track, n, {up('(CASE WHEN f+b>0 THEN f/(f+b) ELSE 1 END)*100')} AS r, {up('t*(1-(CASE WHEN f+b>0 THEN f/(f+b) ELSE 1 END))')} AS w FROM re),
ri AS (SELECT track, (CASE WHEN n<3 THEN 100 ELSE r END)::BIGINT AS rideability, (CASE WHEN n<3 THEN 0 ELSE w END)::BIGINT AS wasted_m FROM (SELECT * FROM r1 UNION ALL SELECT * FROM r2))"""
_add("q_rideability", lambda s, d: T.rideability(event_tracks(s, d)), _RIDE + " SELECT * FROM ri")
_SHAPE = f""", shp AS (SELECT sc.*, n, row_number() OVER w - 1 AS i, greatest(least({up('length_m/1000')},12),2)::INT AS blocks FROM {JOINED} WHERE n>=2 {W}),
shz AS (SELECT *, n//blocks AS size FROM shp), shb AS (SELECT shz.*, unnest(range(0, blocks)) AS b FROM shz),
she AS (SELECT * FROM shb WHERE i=b*size OR i=least((b+1)*size, n-1)),
shg AS (SELECT track, b, arg_min(lng,i) AS ax, arg_min(lat,i) AS ay, arg_max(lng,i) AS bx, arg_max(lat,i) AS by_ FROM she GROUP BY track, b),
shh AS (SELECT *, (by_-ay)*111320.0 AS dy, (bx-ax)*111320.0*cos(radians(ay)) AS dx FROM shg),
shk AS (SELECT track, b, CASE WHEN sqrt(dx*dx+dy*dy)<50 THEN '·' ELSE ['↑N','↗NE','→E','↘SE','↓S','↙SW','←W','↖NW'][((floor((degrees(atan2(dx,dy))+22.5)/45.0)::INT % 8 + 8) % 8)+1] END AS s FROM shh), sp AS (SELECT track, string_agg(s, ' ' ORDER BY b) AS shape FROM shk GROUP BY track)"""
_add("q_shape", lambda s, d: T.shape(event_tracks(s, d)), _SHAPE + " SELECT track, shape FROM sp")
_add("q_loop_closure", lambda s, d: T.loop_closure(event_tracks(s, d), event_tracks(s, d).select("track").distinct().select("track", F.when(F.col("track") % 2 == 0, F.array(F.lit("loop"), F.lit("flat"))).otherwise(F.array(F.lit("flat"))).alias("tags"))),
     f"SELECT track, {up(_CROW)}::BIGINT AS closure_m, {up(_CROW)}<500 AS closed FROM en WHERE track%2=0")
_add("q_resample", lambda s, d: r3(T.resample(event_tracks(s, d), 250.0), "lng", "lat"), """, rs AS (SELECT *, cum_m-step_m AS start_m FROM sc WHERE step_m>0),
ks AS (SELECT *, unnest(range(ceil(start_m/250.0)::BIGINT, floor(cum_m/250.0)::BIGINT+1)) AS k FROM rs)
SELECT track, k*250.0::DOUBLE AS at_m, round(plng+(lng-plng)*(k*250.0-start_m)/step_m,3) AS lng, round(plat+(lat-plat)*(k*250.0-start_m)/step_m,3) AS lat FROM ks WHERE k*250.0<cum_m""")
_add("q_point_at", lambda s, d: r3(T.point_at(event_tracks(s, d), event_tracks(s, d).groupBy("track").agg(F.lit(500.0).alias("at_m"))), "lng", "lat"), """, ps AS (SELECT * FROM sc WHERE step_m>0), pt AS (SELECT track, max(cum_m) AS t FROM ps GROUP BY track),
pa AS (SELECT track, least(500.0, t) AS a FROM pt)
SELECT ps.track, 500.0::DOUBLE AS at_m, round(plng+(lng-plng)*(1-(cum_m-a)/step_m),3) AS lng, round(plat+(lat-plat)*(1-(cum_m-a)/step_m),3) AS lat FROM ps JOIN pa USING (track) WHERE a<=cum_m AND a>cum_m-step_m""")
# the goal rises by one multiple at each vertex past it
_add("q_sample_every", lambda s, d: T.sample_every(event_tracks(s, d)), f"""{TRACKS}, r(track, ord, goal, keep) AS (SELECT track, ord, 1000.0::DOUBLE, true FROM sc WHERE ord=1 UNION ALL SELECT sc.track, sc.ord, CASE WHEN sc.cum_m>=goal THEN goal+1000 ELSE goal END, sc.cum_m>=goal FROM r JOIN sc ON sc.track=r.track AND sc.ord=r.ord+1)
SELECT r.track, r.ord FROM r JOIN en USING (track) WHERE keep OR r.ord=n""")
_RETR = f""", rn AS (SELECT sc.*, n FROM {JOINED} WHERE n>=5),
rh AS (SELECT DISTINCT a.track, a.ord FROM rn a JOIN rn b ON a.track=b.track AND a.cum_m-b.cum_m>=500 AND abs(a.lat-b.lat)<0.002 AND {hav('a.lng','a.lat','b.lng','b.lat')}<200),
rs AS (SELECT rn.track, sum(step_m) AS h FROM rn JOIN rh ON rh.track=rn.track AND rh.ord=rn.ord GROUP BY rn.track),
rx AS (SELECT track, CASE WHEN length_m>0 THEN {up('coalesce(h,0)/length_m',2)} ELSE 0 END AS retraced, {up('coalesce(h,0)')}::BIGINT AS retraced_m, {up('length_m')}::BIGINT AS length_m FROM en LEFT JOIN rs USING (track))"""
_add("q_retrace", lambda s, d: T.retracing(event_tracks(s, d)), _RETR + " SELECT * FROM rx")


def _lines(s, d):
    """Every step of the tracks as a line, and the same with every second step left out, so that there are gaps."""
    p = T.steps(event_tracks(s, d)).where("step_m is not null")
    p = p.select("track", "ord", F.col("plng").alias("lng0"), F.col("plat").alias("lat0"), F.col("lng").alias("lng1"), F.col("lat").alias("lat1"))
    return p.unionAll(p.where("ord % 2 = 0").withColumn("track", F.col("track") + 1_000_000))


_LINES = """, l0 AS (SELECT track, ord, plng AS lng0, plat AS lat0, lng AS lng1, lat AS lat1 FROM st WHERE step_m IS NOT NULL), ln AS (SELECT * FROM l0 UNION ALL SELECT track+1000000, ord, lng0, lat0, lng1, lat1 FROM l0 WHERE ord%2=0)"""
_NEXT = _LINES + f""", lx AS (SELECT *, lead(lng0) OVER w AS a, lead(lat0) OVER w AS b, lead(lng1) OVER w AS c, lead(lat1) OVER w AS e FROM ln {W}),
tl AS (SELECT *, least({hav('lng0','lat0','a','b')},{hav('lng0','lat0','c','e')},{hav('lng1','lat1','a','b')},{hav('lng1','lat1','c','e')}) AS gap_m FROM lx)"""
_add("q_teleport", lambda s, d: r3(T.teleports(_lines(s, d), 1500.0), "gap_m").where("gap_m is not null").select("track", "ord", "gap_m", "teleports"),
     _NEXT + " SELECT track, ord, round(gap_m,3) AS gap_m, gap_m>1500 AS teleports FROM tl WHERE gap_m IS NOT NULL")
# samples along the lines, then the same measure of retracing over the samples
_ALONG = f""", lp AS (SELECT track, ord*2 AS o, lng0 AS lng, lat0 AS lat FROM ln UNION ALL SELECT track, ord*2+1, lng1, lat1 FROM ln), lq AS (SELECT *, lag(lng) OVER v AS plng, lag(lat) OVER v AS plat FROM lp WINDOW v AS (PARTITION BY track ORDER BY o)),
lr AS (SELECT *, {hav('plng','plat','lng','lat')} AS step_m FROM lq), ls AS (SELECT *, sum(step_m) OVER (PARTITION BY track ORDER BY o ROWS UNBOUNDED PRECEDING) AS cum_m FROM lr),
lk AS (SELECT *, cum_m-step_m AS start_m, unnest(range(ceil((cum_m-step_m)/200.0)::BIGINT, floor(cum_m/200.0)::BIGINT+1)) AS k FROM ls WHERE step_m>0),
sp AS (SELECT track, k AS ord, plng+(lng-plng)*(k*200.0::DOUBLE-start_m)/step_m AS lng, plat+(lat-plat)*(k*200.0::DOUBLE-start_m)/step_m AS lat FROM lk WHERE k*200.0<cum_m),
sq AS (SELECT *, lag(lng) OVER w AS plng, lag(lat) OVER w AS plat, count(*) OVER (PARTITION BY track) AS n FROM sp {W}), su AS (SELECT *, {hav('plng','plat','lng','lat')} AS step_m FROM sq),
sv AS (SELECT *, coalesce(sum(step_m) OVER (PARTITION BY track ORDER BY ord ROWS UNBOUNDED PRECEDING),0) AS cum_m FROM su),
sh AS (SELECT DISTINCT a.track, a.ord, a.step_m FROM sv a JOIN sv b ON a.track=b.track AND a.n>=5 AND a.cum_m-b.cum_m>=500 AND abs(a.lat-b.lat)<0.002 AND {hav('a.lng','a.lat','b.lng','b.lat')}<200),
sy AS (SELECT track, sum(step_m) AS h FROM sh GROUP BY track), sz AS (SELECT track, coalesce(sum(step_m),0) AS t FROM sv GROUP BY track), sx AS (SELECT track, CASE WHEN t>0 THEN {up('coalesce(h,0)/t',2)} ELSE 0 END AS f, coalesce(h,0) AS h, t FROM sz LEFT JOIN sy USING (track))"""
_KM = lambda c: f"format('{{:.1f}}', floor((floor({c}+0.5)/1000)*10+0.5)/10)"
_add("q_valid_trace", lambda s, d: r3(T.valid_trace(_lines(s, d)), "worst_gap_m"), _NEXT + _ALONG + f""", vt AS (SELECT track, count(*) FILTER (gap_m>3000) AS t, coalesce(max(gap_m),0) AS g FROM tl GROUP BY track),
vr AS (SELECT *, coalesce(f,0) AS r, CASE WHEN vt.t>0 THEN 'teleport: ' || vt.t || ' gap(s) > 3000m (worst: ' || floor(g+0.5)::BIGINT || 'm)' WHEN coalesce(f,0)>0.10 THEN 'retracing: ' || floor(f*100+0.5)::BIGINT || '% of route revisits same area (' || {_KM('h')} || 'km of ' || {_KM('sx.t')} || 'km)' END AS reason FROM vt LEFT JOIN sx USING (track))
SELECT track, reason IS NULL AS valid, reason, round(g,3) AS worst_gap_m, CASE WHEN reason LIKE 'teleport%' THEN 0 ELSE r END AS retraced FROM vr""")
_add("q_reversals", lambda s, d: T.reversals(_lines(s, d)), _LINES + f""", rb AS (SELECT *, degrees(atan2(lng1-lng0, lat1-lat0)) AS b FROM ln), rt AS (SELECT *, {turn('lag(b) OVER w','b')}>120 AS t FROM rb {W})
SELECT track, count(*) FILTER (t) AS reversals, min(ord) FILTER (t) AS first FROM rt GROUP BY track""")
_add("q_islands", lambda s, d: T.islands(event_tracks(s, d).withColumn("k", F.floor(F.col("lng") / 0.005).cast("long")), "track", "ord", "k").groupBy("track", "island").agg(F.min("k").alias("k"), F.count("*").alias("n")),
     f""", ik AS (SELECT *, floor(lng/0.005::DOUBLE)::BIGINT AS k FROM tr), ch AS (SELECT *, CASE WHEN k IS DISTINCT FROM lag(k) OVER w OR row_number() OVER w=1 THEN 1 ELSE 0 END AS c FROM ik {W}),
isl AS (SELECT *, sum(c) OVER (PARTITION BY track ORDER BY ord ROWS UNBOUNDED PRECEDING)::BIGINT AS island FROM ch) SELECT track, island, min(k) AS k, count(*) AS n FROM isl GROUP BY track, island""")
_add("q_breaks", lambda s, d: T.breaks(event_tracks(s, d), 1000.0).groupBy("track", "part").agg(F.count("*").alias("points")),
     ", br AS (SELECT *, 1+sum(CASE WHEN step_m>1000 THEN 1 ELSE 0 END) OVER (PARTITION BY track ORDER BY ord ROWS UNBOUNDED PRECEDING)::BIGINT AS part FROM st) SELECT track, part, count(*) AS points FROM br GROUP BY track, part")
_add("q_longest_run", lambda s, d: T.longest_run(event_tracks(s, d), "track", "ord", F.col("lat") > 45.4), f""", lf AS (SELECT *, lat>45.4 AS f FROM tr), lc AS (SELECT *, CASE WHEN f IS DISTINCT FROM lag(f) OVER w THEN 1 ELSE 0 END AS c FROM lf {W}),
li AS (SELECT *, sum(c) OVER (PARTITION BY track ORDER BY ord ROWS UNBOUNDED PRECEDING) AS i FROM lc), lg AS (SELECT track, i, count(*) AS n FROM li WHERE f GROUP BY track, i)
SELECT track, coalesce(max(n),0) AS run FROM (SELECT DISTINCT track FROM tr) LEFT JOIN lg USING (track) GROUP BY track""")
_add("q_transitions", lambda s, d: T.transition_penalty(event_tracks(s, d).withColumn("lv", (F.col("ord") * 7 + F.col("track")) % 6), "track", "ord", "lv"),
     f", tv AS (SELECT track, lag((ord*7+track)%6) OVER w - (ord*7+track)%6 AS drop_ FROM tr {W}) SELECT track, greatest(sum(CASE WHEN drop_>=3 THEN -1.5 WHEN drop_>=2 THEN -0.5 ELSE 0 END),-3)::DOUBLE AS penalty FROM tv GROUP BY track")
_GP = "CASE WHEN g<200 THEN g/2000 WHEN g<1000 THEN 0.1+(g-200)/800 ELSE 1.1+(g-1000)/500 END"
_add("q_gap_penalty", lambda s, d: r3(T.gap_totals(T.steps(event_tracks(s, d)), "track", "step_m"), "gap_sum_m", "gap_max_m", "penalty"),
     f", gp AS (SELECT track, CASE WHEN step_m>10 THEN step_m END AS g FROM st) SELECT track, count(g) AS gaps, round(coalesce(sum(g),0),3) AS gap_sum_m, round(max(g),3) AS gap_max_m, round(least(coalesce(sum({_GP}),0),8.0),3) AS penalty FROM gp GROUP BY track")
_add("q_densify", lambda s, d: r3(T.densify(event_tracks(s, d)), "lng", "lat").groupBy("track").agg(F.count("*").alias("points"), F.round(F.sum("lng"), 1).alias("lng_sum")),
     f""", dn AS (SELECT *, lead(lng) OVER w AS nlng, lead(lat) OVER w AS nlat FROM tr {W}), dd AS (SELECT *, {hav('lng','lat','nlng','nlat')} AS dist FROM dn),
dp AS (SELECT *, (CASE WHEN dist>80 THEN ceil(dist/50.0) ELSE 1 END)::INT AS parts FROM dd), de AS (SELECT *, unnest(range(0, parts)) AS sub FROM dp)
SELECT track, count(*) AS points, round(sum(round(CASE WHEN sub=0 THEN lng ELSE lng+(nlng-lng)*(sub::DOUBLE/parts) END,3)),1) AS lng_sum FROM de GROUP BY track""")
_add("q_elevation", lambda s, d: T.fill_elevation(event_tracks(s, d).withColumn("ele", F.when(F.col("ord") % 9 == 4, (F.col("ord") % 50).cast("double")))).select("track", "ord", F.round("ele", 3).alias("ele")),
     f""", el AS (SELECT *, CASE WHEN ord%9=4 THEN (ord%50)::DOUBLE END AS e FROM sc), eb AS (SELECT *, last_value(e IGNORE NULLS) OVER b AS e0, last_value(CASE WHEN e IS NOT NULL THEN cum_m END IGNORE NULLS) OVER b AS c0,
first_value(e IGNORE NULLS) OVER f AS e1, first_value(CASE WHEN e IS NOT NULL THEN cum_m END IGNORE NULLS) OVER f AS c1 FROM el WINDOW b AS (PARTITION BY track ORDER BY ord ROWS UNBOUNDED PRECEDING), f AS (PARTITION BY track ORDER BY ord ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
SELECT track, ord, round(coalesce(e, e0+(e1-e0)*(cum_m-c0)/nullif(c1-c0,0), e0, e1),3) AS ele FROM eb""")
