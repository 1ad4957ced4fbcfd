"""DuckDB SQL that answers every registered query without Spark.

The domain tables are built again as CTEs. The search for nearest lines pairs
points and edges by bounding box alone, with no grid; tiers are filled one
after the other, each with what the earlier ones left.
"""

from __future__ import annotations

_PARTS: dict[str, tuple[tuple[str, ...], str]] = {}


def _part(name: str, needs: tuple[str, ...], sql: str) -> None:
    _PARTS[name] = (needs, sql)


def query(needs: tuple[str, ...], sql: str) -> str:
    """`sql` preceded by the named parts and everything they need."""
    order: list[str] = []

    def visit(name: str) -> None:
        for n in _PARTS[name][0]:
            visit(n)
        if name not in order:
            order.append(name)

    for n in needs:
        visit(n)
    ctes = ",\n".join(f"{n} AS MATERIALIZED ({_PARTS[n][1]})" for n in order)
    return f"WITH {ctes}\n{sql}" if ctes else sql


_part(
    "streams",
    (),
    """
SELECT o_orderkey AS linear_feature_id, 354087611 + l AS blue_line_key, l, i,
  CAST(CASE WHEN l % 50 = 7 THEN 6010 WHEN l % 4 < 2 THEN 1200 ELSE 1000 END AS INTEGER) AS edge_type,
  CASE WHEN l % 47 = 9 THEN NULL WHEN l % 43 = 5 THEN concat('999.', l) ELSE concat('100.', 1000000 + l) END
    AS wscode_ltree,
  CASE WHEN l % 41 = 3 THEN NULL ELSE concat('100.', 1000000 + l, '.', i) END AS localcode_ltree,
  CASE WHEN l % 4 < 2 THEN 1000 + l // 4 END AS waterbody_key,
  concat('GRP', l % 7) AS watershed_group_code,
  CAST(130 * i AS DOUBLE) + 0.25::DOUBLE AS downstream_route_measure,
  CAST(130 * (i + 1) AS DOUBLE) + 0.25::DOUBLE AS upstream_route_measure,
  concat('River ', l % 20) AS gnis_name,
  CAST(o_orderkey % 400 AS DOUBLE) / 10000.0::DOUBLE AS gradient,
  CAST(1 + o_orderkey % 7 AS INTEGER) AS stream_order
FROM (SELECT o_orderkey, o_orderkey // 10 AS l, o_orderkey % 10 AS i FROM orders)
""",
)
_part(
    "vertices",
    ("streams",),
    """
SELECT linear_feature_id, blue_line_key, e,
  CAST((l % 20) * 1400 + (l * 37) % 300 + 60 * j AS DOUBLE) AS x,
  CAST((l // 20) * 500 + (l * 53) % 200 + (l * 31 + 17 * j * j) % 97 AS DOUBLE) AS y,
  CAST(500 + l % 100 AS DOUBLE) + 0.5::DOUBLE * j AS z,
  65.0::DOUBLE * j + 0.25::DOUBLE AS m
FROM (SELECT *, 2 * i + e AS j FROM streams CROSS JOIN (VALUES (0), (1), (2)) v(e))
""",
)
_part(
    "edges",
    ("vertices",),
    """
SELECT a.linear_feature_id, a.blue_line_key, a.e AS edge_no,
  a.x AS x1, a.y AS y1, a.z AS z1, a.m AS m1, b.x AS x2, b.y AS y2, b.z AS z2, b.m AS m2
FROM vertices a JOIN vertices b ON a.linear_feature_id = b.linear_feature_id AND b.e = a.e + 1
""",
)
_part(
    "source",
    (),
    """
SELECT event_id AS fish_observation_point_id,
  CASE WHEN event_id % 13 <> 0 THEN l // 4 + event_id % 2 END AS wbody_id,
  upper(substr(event_type, 1, 2)) AS species_code,
  user_id % 9 AS agency_id,
  CASE WHEN event_id % 10 = 0 THEN 'Summary' ELSE 'Observation' END AS point_type_code,
  CAST(ts AS DATE) AS observation_date,
  concat('Agency ', user_id % 9) AS agency_name,
  concat('src', event_id % 3) AS source,
  concat('report ', user_id) AS source_ref,
  CAST(9 + user_id % 3 AS INTEGER) AS utm_zone,
  CAST(400000 + (user_id % 20) * 1400 AS INTEGER) AS utm_easting,
  CAST(5000000 + (user_id % 5) * 500 AS INTEGER) AS utm_northing,
  CASE WHEN event_id % 4 <> 1 THEN 'A' END AS activity_code,
  CASE WHEN event_id % 4 <> 1 THEN 'Activity' END AS activity,
  CASE WHEN event_id % 4 <> 0 THEN 'A' END AS life_stage_code,
  CASE WHEN event_id % 4 <> 0 THEN 'Adult' END AS life_stage,
  event_type AS species_name,
  concat(lpad(CAST(l // 4 + 1 AS VARCHAR), 5, '0'), 'ABCD') AS waterbody_identifier,
  CASE event_id % 6 WHEN 0 THEN 'Lake' WHEN 1 THEN 'Wetland' WHEN 5 THEN NULL ELSE 'Stream' END AS waterbody_type,
  concat('River ', l % 20) AS gazetted_name,
  concat('100-', 1000000 + l) AS new_watershed_code,
  concat('100-', 1000000 + l) AS trimmed_watershed_code,
  concat('report/', user_id) AS acat_report_url,
  concat('F', event_id % 5) AS feature_code,
  CAST((l % 20) * 1400 + (event_id * 131) % 1500
    - CASE WHEN event_id % 17 = 0 THEN (event_id * 11) % 9000 ELSE 0 END AS DOUBLE) AS x,
  CAST((l // 20) * 500 + (event_id * event_id * 29) % 700 - 100 AS DOUBLE) AS y
FROM (SELECT *, (event_id * 7) % (SELECT count(*) // 10 FROM orders) AS l FROM events)
""",
)
_part(
    "wb_numbers",
    ("streams",),
    "SELECT DISTINCT waterbody_key, waterbody_key - 1000 AS id FROM streams WHERE waterbody_key IS NOT NULL",
)
_part(
    "stream_xref",
    ("streams",),
    """
SELECT concat('100', 1000000 + l) AS watershed_code_50k, linear_feature_id AS linear_feature_id_20k
FROM streams WHERE i % 3 = 0
""",
)
_part(
    "species",
    (),
    """
SELECT DISTINCT CAST(length(event_type) * 100 + ascii(event_type) AS INTEGER) AS species_id,
  upper(substr(event_type, 1, 2)) AS code, event_type AS name FROM events
""",
)
_part(
    "keyed_all",
    ("source",),
    """
SELECT *, left(sha1(concat_ws('|', source, species_code, CAST(observation_date AS VARCHAR),
    CAST(utm_zone AS VARCHAR), CAST(utm_easting AS VARCHAR), CAST(utm_northing AS VARCHAR),
    life_stage_code, activity_code)), 10) AS observation_key
FROM source
""",
)
_part(
    "obs",
    ("keyed_all",),
    """
SELECT k.* FROM keyed_all k JOIN
  (SELECT observation_key, min(fish_observation_point_id) AS first_id FROM keyed_all GROUP BY observation_key) f
ON k.observation_key = f.observation_key AND k.fish_observation_point_id = f.first_id
""",
)
_part(
    "eligible",
    ("streams",),
    """
SELECT * FROM streams WHERE localcode_ltree IS NOT NULL AND edge_type <> 6010
  AND string_split(wscode_ltree, '.')[1] <> '999'
""",
)
# squared distance and measure of point (x, y) on an edge
_ON_EDGE = """
SELECT *,
  CASE WHEN along <= 0 THEN (x - x1) * (x - x1) + (y - y1) * (y - y1)
    WHEN along >= len2 THEN (x - x2) * (x - x2) + (y - y2) * (y - y2)
    ELSE across * across / len2 END AS d2,
  CASE WHEN along <= 0 THEN m1 WHEN along >= len2 THEN m2 ELSE m1 + along / len2 * (m2 - m1) END AS measure
FROM (SELECT *, (x - x1) * (x2 - x1) + (y - y1) * (y2 - y1) AS along,
    (x - x1) * (y2 - y1) - (y - y1) * (x2 - x1) AS across,
    (x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1) AS len2
  FROM {pairs})
"""
_part(
    "within",
    ("obs", "edges", "eligible"),
    f"""
SELECT observation_key, linear_feature_id, blue_line_key, waterbody_key, d AS distance, measure
FROM (SELECT *, sqrt(d2) AS d FROM ({
        _ON_EDGE.format(
            pairs='''(
    SELECT o.observation_key, o.x, o.y, e.*, s.waterbody_key
    FROM (SELECT *, least(x1, x2) - 1500 AS xa, greatest(x1, x2) + 1500 AS xb,
        least(y1, y2) - 1500 AS ya, greatest(y1, y2) + 1500 AS yb FROM edges) e
    JOIN eligible s ON s.linear_feature_id = e.linear_feature_id
    JOIN obs o ON o.y >= e.ya AND o.y <= e.yb AND o.x >= e.xa AND o.x <= e.xb)'''
        )
    }))
WHERE d < 1500
QUALIFY row_number() OVER (PARTITION BY observation_key, linear_feature_id ORDER BY d, measure) = 1
""",
)
_part(
    "nearest",
    ("within",),
    """
SELECT * FROM within
QUALIFY row_number() OVER (PARTITION BY observation_key ORDER BY distance, linear_feature_id) <= 100
""",
)
_part(
    "candidates",
    ("nearest", "streams"),
    """
SELECT tied.observation_key, tied.linear_feature_id, s.wscode_ltree AS wscode, s.localcode_ltree AS localcode,
  s.waterbody_key, tied.blue_line_key, a.measure, tied.distance
FROM nearest tied
JOIN (SELECT observation_key, blue_line_key, min(linear_feature_id) AS anchor, any_value(least_d) AS least_d
  FROM (SELECT *, min(distance) OVER (PARTITION BY observation_key, blue_line_key) AS least_d FROM nearest)
  WHERE distance = least_d GROUP BY observation_key, blue_line_key) r
ON r.observation_key = tied.observation_key AND r.blue_line_key = tied.blue_line_key
  AND r.least_d = tied.distance
JOIN nearest a ON a.observation_key = r.observation_key AND a.linear_feature_id = r.anchor
JOIN streams s ON s.linear_feature_id = r.anchor
""",
)
_part(
    "wb_targets",
    ("wb_numbers",),
    """
SELECT DISTINCT d.id AS wbody_id, x.key_20k AS waterbody_key
FROM (SELECT id, ltrim(concat(lpad(CAST(id + 1 AS VARCHAR), 5, '0'), 'ABCD'), '0') AS code FROM wb_numbers) d
JOIN (SELECT CAST(id + 1 AS VARCHAR) || 'ABCD' AS code, id + 1000 AS key_20k FROM wb_numbers) x ON x.code = d.code
WHERE x.key_20k IN (SELECT waterbody_key FROM wb_numbers)
""",
)
_part(
    "wb_pairs",
    ("obs", "wb_targets"),
    """
SELECT DISTINCT o.observation_key, t.waterbody_key FROM obs o JOIN wb_targets t ON t.wbody_id = o.wbody_id
WHERE o.waterbody_type = 'Lake' OR o.waterbody_type = 'Wetland'
""",
)
_part(
    "listed",
    ("candidates", "obs", "stream_xref"),
    """
SELECT c.* FROM candidates c JOIN obs o ON o.observation_key = c.observation_key
WHERE o.waterbody_type <> 'Lake' AND o.waterbody_type <> 'Wetland'
  AND EXISTS (SELECT 1 FROM stream_xref x WHERE x.linear_feature_id_20k = c.linear_feature_id
    AND x.watershed_code_50k = replace(o.new_watershed_code, '-', ''))
""",
)


def _tier(accepted: str, tag: str, extra: str = "TRUE") -> str:
    """All candidates at an observation's smallest accepted distance, lowest measure first."""
    return f"""
SELECT c.*, '{tag}' AS match_type FROM candidates c
JOIN (SELECT observation_key, min(distance) AS d FROM ({accepted}) GROUP BY observation_key) w
ON w.observation_key = c.observation_key AND w.d = c.distance
WHERE {extra}
QUALIFY row_number() OVER (PARTITION BY c.observation_key ORDER BY c.measure, c.linear_feature_id) = 1
"""


_part(
    "tier_d",
    ("candidates", "wb_pairs"),
    _tier(
        "SELECT k.* FROM candidates k SEMI JOIN wb_pairs p"
        " ON p.observation_key = k.observation_key AND p.waterbody_key = k.waterbody_key",
        "D. matched - waterbody; construction line within 1500m; lookup",
        "c.waterbody_key IS NOT NULL",
    ),
)
_part(
    "tier_e",
    ("tier_d", "obs"),
    _tier(
        "SELECT k.* FROM candidates k WHERE k.observation_key IN (SELECT observation_key FROM obs"
        " WHERE waterbody_type IN ('Lake', 'Wetland') AND wbody_id IS NOT NULL)"
        " AND k.observation_key NOT IN (SELECT observation_key FROM tier_d)",
        "E. matched - waterbody; construction line within 1500m; closest",
    ),
)
_part(
    "tier_a",
    ("listed",),
    _tier("SELECT * FROM listed WHERE distance <= 100", "A. matched - stream; within 100m; lookup"),
)
_part(
    "tier_b",
    ("tier_a", "obs"),
    _tier(
        "SELECT k.* FROM candidates k WHERE k.distance <= 100"
        " AND k.observation_key IN (SELECT observation_key FROM obs WHERE waterbody_type = 'Stream')"
        " AND k.observation_key NOT IN (SELECT observation_key FROM tier_a)",
        "B. matched - stream; within 100m; closest stream",
    ),
)
_part(
    "tier_c",
    ("tier_b",),
    _tier(
        "SELECT * FROM listed WHERE distance > 100 AND distance < 500"
        " AND observation_key NOT IN (SELECT observation_key FROM tier_a)"
        " AND observation_key NOT IN (SELECT observation_key FROM tier_b)",
        "C. matched - stream; 100-500m; lookup",
    ),
)
_part(
    "matched",
    ("tier_a", "tier_b", "tier_c", "tier_d", "tier_e"),
    " UNION ALL ".join(f"SELECT * FROM tier_{t}" for t in "deabc"),
)
_part(
    "rounded",
    ("matched", "streams"),
    """
SELECT m.observation_key, m.linear_feature_id, m.wscode, m.localcode, m.waterbody_key, m.blue_line_key,
  s.watershed_group_code, m.measure, m.distance, m.match_type,
  ceil(greatest(s.downstream_route_measure, floor(least(s.upstream_route_measure, m.measure))))
    AS downstream_route_measure
FROM matched m JOIN streams s ON s.linear_feature_id = m.linear_feature_id
""",
)


def _located(events: str) -> str:
    """Position of each event (`event`, `route`, `pos`): the edge that starts at or
    before it and ends after it, else the one that ends at it."""
    return f"""
SELECT v.event, CASE WHEN pos = m2 THEN x2 ELSE x1 + (pos - m1) / (m2 - m1) * (x2 - x1) END AS geom_x,
  CASE WHEN pos = m2 THEN y2 ELSE y1 + (pos - m1) / (m2 - m1) * (y2 - y1) END AS geom_y,
  CASE WHEN pos = m2 THEN z2 ELSE z1 + (pos - m1) / (m2 - m1) * (z2 - z1) END AS geom_z
FROM ({events}) v LEFT JOIN edges e ON e.blue_line_key = v.route AND e.m1 <= v.pos AND v.pos <= e.m2
QUALIFY row_number() OVER (PARTITION BY v.event ORDER BY pos = m2, linear_feature_id, edge_no) = 1
"""


_part(
    "positions",
    ("rounded", "edges"),
    _located(
        "SELECT observation_key AS event, blue_line_key AS route, downstream_route_measure AS pos FROM rounded"
    ),
)
_OUTPUT_TEXT = """
  o.observation_key, o.fish_observation_point_id, o.wbody_id, o.species_code, o.agency_id, o.point_type_code,
  CAST(o.observation_date AS VARCHAR) AS observation_date, o.agency_name, o.source, o.source_ref, o.utm_zone,
  o.utm_easting, o.utm_northing, o.activity_code, o.activity, o.life_stage_code, o.life_stage, o.species_name,
  o.waterbody_identifier, o.waterbody_type, o.gazetted_name, o.new_watershed_code, o.trimmed_watershed_code,
  o.acat_report_url, o.feature_code, r.linear_feature_id, r.wscode, r.localcode, r.blue_line_key,
  r.watershed_group_code, r.downstream_route_measure, r.match_type, r.distance AS distance_to_stream
"""
_part(
    "snapped",
    ("positions", "obs"),
    f"""
SELECT {_OUTPUT_TEXT}, p.geom_x, p.geom_y, p.geom_z
FROM obs o JOIN rounded r ON r.observation_key = o.observation_key
JOIN positions p ON p.event = o.observation_key
""",
)
_part(
    "species_of",
    ("snapped", "species"),
    "SELECT s.*, c.species_id FROM snapped s LEFT JOIN species c ON c.code = s.species_code",
)
_part(
    "gathered",
    ("species_of",),
    """
SELECT (blue_line_key + 1 - 354087611) * 10000000 + CAST(round_even(downstream_route_measure, 0) AS BIGINT)
    AS fish_obsrvtn_event_id,
  arg_min(linear_feature_id, (linear_feature_id, observation_key)) AS linear_feature_id,
  arg_min(wscode, (linear_feature_id, observation_key)) AS wscode_ltree,
  arg_min(localcode, (linear_feature_id, observation_key)) AS localcode_ltree,
  arg_min(watershed_group_code, (linear_feature_id, observation_key)) AS watershed_group_code,
  arg_min(geom_z, (linear_feature_id, observation_key)) AS geom_z,
  blue_line_key, downstream_route_measure,
  list(fish_observation_point_id ORDER BY fish_observation_point_id) AS obs_ids,
  list(match_type ORDER BY fish_observation_point_id) AS match_types,
  list(species_code ORDER BY fish_observation_point_id) AS species_codes,
  list(species_id ORDER BY fish_observation_point_id) AS species_ids,
  list(distance_to_stream ORDER BY fish_observation_point_id) AS distances
FROM species_of GROUP BY blue_line_key, downstream_route_measure
""",
)


def _cut(n: int) -> str:
    """Events with their arrays cut after every n observations."""
    return f"""
SELECT g.* EXCLUDE (obs_ids, match_types, species_codes, species_ids, distances), p.* EXCLUDE (route, pos)
FROM gathered g JOIN (
  SELECT blue_line_key AS route, downstream_route_measure AS pos, part_no,
    list(fish_observation_point_id ORDER BY fish_observation_point_id) AS obs_ids,
    list(match_type ORDER BY fish_observation_point_id) AS match_types,
    list(species_code ORDER BY fish_observation_point_id) AS species_codes,
    list(species_id ORDER BY fish_observation_point_id) AS species_ids,
    list(distance_to_stream ORDER BY fish_observation_point_id) AS distances
  FROM (SELECT *, (row_number() OVER (PARTITION BY blue_line_key, downstream_route_measure
      ORDER BY fish_observation_point_id) - 1) // {n} AS part_no FROM species_of)
  GROUP BY 1, 2, 3) p ON p.route = g.blue_line_key AND p.pos = g.downstream_route_measure
"""


_part("cut_usual", ("gathered",), _cut(100_000))
_part("cut_small", ("gathered",), _cut(2))
_part(
    "reach",
    ("candidates",),
    "SELECT observation_key, min(distance) AS distance FROM candidates GROUP BY observation_key",
)



def _unmatched(n: int) -> str:
    return f"""
SELECT first_id AS fish_obsrvtn_pnt_distinct_id, part_no, array_to_string(list(id ORDER BY id), ',') AS obs_ids,
  array_to_string(list(species_id ORDER BY id), ',') AS species_ids,
  round(any_value(least_distance), 6) AS distance_to_stream, x, y
FROM (SELECT o.fish_observation_point_id AS id, s.species_id, o.x, o.y,
    min(o.fish_observation_point_id) OVER (PARTITION BY o.x, o.y) AS first_id,
    min(r.distance) OVER (PARTITION BY o.x, o.y) AS least_distance,
    (row_number() OVER (PARTITION BY o.x, o.y ORDER BY o.fish_observation_point_id) - 1) // {n} AS part_no
  FROM obs o LEFT JOIN reach r ON r.observation_key = o.observation_key
  LEFT JOIN species s ON s.code = o.species_code
  WHERE o.observation_key NOT IN (SELECT observation_key FROM matched))
GROUP BY first_id, part_no, x, y
"""


def _branch(route: str) -> str:
    return f"'1' || regexp_replace(to_base({route}, 4), '(.)', '.\\1', 'g')"


_part("branches", (), f"SELECT route, {_branch('route')} AS code FROM (SELECT DISTINCT o_orderkey // 10 AS route FROM orders)")
_part(
    "branching",
    ("snapped",),
    f"""
SELECT DISTINCT species_code, blue_line_key, downstream_route_measure, wscode, spot, wscode || '.' || spot AS localcode
FROM (SELECT species_code, blue_line_key, downstream_route_measure, {_branch("blue_line_key - 354087611")} AS wscode,
    CAST(linear_feature_id % 10 // 3 AS VARCHAR) AS spot FROM snapped)
""",
)
_part(
    "uppermost",
    ("branching",),
    """
SELECT * FROM branching a WHERE NOT EXISTS (
  SELECT 1 FROM branching b WHERE b.species_code = a.species_code AND (
    (b.blue_line_key = a.blue_line_key AND b.downstream_route_measure > a.downstream_route_measure)
    OR (b.wscode = a.wscode AND b.spot > a.spot)
    OR (starts_with(b.wscode, a.wscode || '.') AND split_part(substr(b.wscode, length(a.wscode) + 2), '.', 1) > a.spot)))
""",
)


def oracle_sql() -> dict[str, str]:
    q = query
    tier_columns = (
        "observation_key, linear_feature_id, wscode, localcode, waterbody_key, blue_line_key,"
        " round(measure, 6) AS downstream_route_measure, round(distance, 6) AS distance_to_stream, match_type"
    )
    mm = "CAST(round({0} * 1000) AS BIGINT)"
    event_text = (
        "fish_obsrvtn_event_id, part_no, linear_feature_id, wscode_ltree, localcode_ltree, blue_line_key,"
        " watershed_group_code, downstream_route_measure, round(geom_z, 6) AS geom_z,"
        " array_to_string(obs_ids, ',') AS obs_ids, array_to_string(match_types, ',') AS match_types,"
        " array_to_string(species_codes, ',') AS species_codes, array_to_string(species_ids, ',') AS species_ids,"
        f" array_to_string(list_transform(distances, lambda d: {mm.format('d')}), ',') AS distances_mm"
    )
    measure_of = "CAST((e * 37) % 1400 AS DOUBLE) + 0.25::DOUBLE * (e % 4)"
    out = {
        "event_heads": q(
            ("gathered", "uppermost", "species"),
            "SELECT g.fish_obsrvtn_event_id, g.linear_feature_id, g.blue_line_key, g.downstream_route_measure,"
            " (len(g.obs_ids) + 1) // 2 AS n_parts, len(g.obs_ids) AS n_observations,"
            " coalesce(array_to_string(list_sort(m.ids), ','), '') AS maximal_species"
            " FROM gathered g LEFT JOIN (SELECT blue_line_key, downstream_route_measure, list(DISTINCT species_id) AS ids"
            " FROM uppermost u JOIN species s ON s.code = u.species_code GROUP BY ALL) m"
            " ON m.blue_line_key = g.blue_line_key AND m.downstream_route_measure = g.downstream_route_measure",
        ),
        "exported_positions": q(
            ("snapped",), "SELECT observation_key, round(geom_x, 6) AS geom_x, round(geom_y, 6) AS geom_y FROM snapped"
        ),
        "path_containment": q(
            ("branches",),
            "SELECT u.route, count(*) AS n_below, CAST(sum(l.route) AS BIGINT) AS sum_below"
            " FROM branches u JOIN branches l ON starts_with(l.code, u.code || '.') GROUP BY u.route",
        ),
        "species_farthest_upstream": q(
            ("uppermost",), "SELECT blue_line_key, downstream_route_measure, wscode, localcode, species_code FROM uppermost"
        ),
        "maximal_species": q(
            ("uppermost", "species"),
            "SELECT blue_line_key, downstream_route_measure,"
            " array_to_string(list_sort(list(DISTINCT species_id)), ',') AS maximal_species"
            " FROM uppermost u JOIN species s ON s.code = u.species_code GROUP BY ALL",
        ),
        "obs_key": q(("keyed_all",), "SELECT fish_observation_point_id, observation_key FROM keyed_all"),
        "obs_dedup": q(
            ("obs",),
            "SELECT observation_key, fish_observation_point_id, species_code, waterbody_type, x, y FROM obs",
        ),
        "obs_dedup_observation_type": q(
            ("keyed_all",),
            "SELECT observation_key, min(fish_observation_point_id) AS fish_observation_point_id"
            " FROM keyed_all WHERE point_type_code = 'Observation' GROUP BY observation_key",
        ),
        "obs_duplicates": q(
            ("source",),
            "SELECT source, species_code, CAST(observation_date AS VARCHAR) AS observation_date, utm_zone,"
            " utm_easting, utm_northing, life_stage_code, activity_code, count(*) AS n FROM source"
            " GROUP BY ALL HAVING count(*) > 1",
        ),
        "key_collisions_report": q(
            ("keyed_all",),
            "SELECT CAST(sum(n) AS BIGINT) AS n_tuples, count(*) AS n_keys, CAST(sum(n - 1) AS BIGINT) AS n_merged"
            " FROM (SELECT observation_key, count(DISTINCT (source, species_code, observation_date, utm_zone,"
            " utm_easting, utm_northing, life_stage_code, activity_code)) AS n FROM keyed_all GROUP BY 1)",
        ),
        "unique_key_check": q(
            ("keyed_all",),
            "SELECT observation_key, count(*) AS n FROM keyed_all GROUP BY 1 HAVING count(*) > 1",
        ),
        "multipart_points": q(
            (),
            "SELECT event_id, CAST(event_id % 1000 + p AS DOUBLE) AS x, CAST(user_id * p AS DOUBLE) AS y"
            " FROM events JOIN (VALUES (0), (1), (2)) v(p) ON p < event_id % 4",
        ),
        "streams_eligible": q(
            ("eligible",),
            "SELECT linear_feature_id, blue_line_key, edge_type, wscode_ltree, localcode_ltree FROM eligible",
        ),
        "path_descendants": q(
            ("streams",),
            "SELECT linear_feature_id, string_split(wscode_ltree, '.')[1] = '999' AS below_999,"
            " string_split(localcode_ltree, '.')[1:2] = ['100', CAST(1000000 + l AS VARCHAR)] AS below_own,"
            " string_split(localcode_ltree, '.')[1:2] = ['100', '1000002'] AS below_route"
            " FROM streams",
        ),
        "path_order_rank": q(
            ("streams",),
            "SELECT linear_feature_id, row_number() OVER (PARTITION BY blue_line_key ORDER BY"
            " string_split(concat(stream_order, '.', localcode_ltree), '.'), linear_feature_id) AS place"
            " FROM streams WHERE localcode_ltree IS NOT NULL",
        ),
        "read_observations_binary": q(
            ("source",),
            "SELECT fish_observation_point_id, wbody_id, species_code, CAST(observation_date AS VARCHAR)"
            " AS observation_date, utm_zone, x + part AS x, y FROM source CROSS JOIN (VALUES (0), (1)) v(part)"
            " WHERE part = 0 OR fish_observation_point_id % 5 = 0",
        ),
        "read_streams": q(
            ("streams", "edges"),
            "SELECT s.* EXCLUDE (l, i), 3 AS n_vertices, e.z2 AS second_z FROM streams s"
            " JOIN edges e ON e.linear_feature_id = s.linear_feature_id AND e.edge_no = 0",
        ),
        "read_waterbody_dictionary": q(
            ("wb_numbers",),
            "SELECT CAST(id AS INTEGER) AS id, concat(lpad(CAST(id + 1 AS VARCHAR), 5, '0'), 'ABCD') AS waterbody_identifier,"
            " CASE id % 3 WHEN 0 THEN '' WHEN 1 THEN concat('Big \"B\" Lake, North', chr(10), 'Arm') END AS gazetted_name,"
            " id % 3 = 2 AS no_name FROM wb_numbers",
        ),
        "read_species": q(("species",), "SELECT species_id, code, name FROM species"),
        "read_waterbody_xref": q(
            ("wb_numbers",),
            "SELECT id + 1 AS waterbody_key_50k, 'ABCD' AS watershed_group_code_50k, waterbody_key AS waterbody_key_20k"
            " FROM wb_numbers",
        ),
        "read_waterbodies": q(("wb_numbers",), "SELECT waterbody_key FROM wb_numbers"),
        "read_stream_xref": q(("stream_xref",), "SELECT * FROM stream_xref"),
        "path_order_extremes": q(
            ("streams",),
            "SELECT watershed_group_code, array_to_string(min(p), '.') AS first_path,"
            " array_to_string(max(p), '.') AS last_path FROM (SELECT watershed_group_code,"
            " string_split(concat(stream_order, '.', localcode_ltree), '.') AS p FROM streams"
            " WHERE localcode_ltree IS NOT NULL) GROUP BY 1",
        ),
        "point_edge_distance": q(
            ("source", "edges"),
            "SELECT fish_observation_point_id, edge_no, round(sqrt(d2), 6) AS distance, round(measure, 6) AS measure"
            " FROM ("
            + _ON_EDGE.format(
                pairs="(SELECT o.fish_observation_point_id, o.x, o.y, e.* FROM source o JOIN edges e"
                " ON e.linear_feature_id = o.fish_observation_point_id * 7 % (SELECT count(*) FROM orders))"
            )
            + ")",
        ),
        "knn_nearest": q(
            ("within",),
            "SELECT observation_key, linear_feature_id, round(distance, 6) AS distance, round(measure, 6) AS measure"
            " FROM within QUALIFY row_number() OVER"
            " (PARTITION BY observation_key ORDER BY distance, linear_feature_id) <= 10",
        ),
        "knn_candidates": q(
            ("nearest",),
            "SELECT observation_key, count(*) AS n_lines, CAST(sum(linear_feature_id) AS BIGINT) AS sum_ids,"
            f" CAST(sum({mm.format('distance')}) AS BIGINT) AS sum_distance_mm,"
            f" CAST(sum({mm.format('measure')}) AS BIGINT) AS sum_measure_mm,"
            " round(max(distance), 6) AS farthest FROM nearest GROUP BY 1",
        ),
        "knn_within_radius": q(
            ("within",),
            "SELECT observation_key, count(*) AS n_lines, CAST(sum(linear_feature_id) AS BIGINT) AS sum_ids,"
            " round(max(distance), 6) AS farthest FROM within GROUP BY 1",
        ),
        "closest_per_route": q(
            ("candidates",),
            "SELECT observation_key, linear_feature_id, wscode, localcode, waterbody_key, blue_line_key,"
            " round(measure, 6) AS measure, round(distance, 6) AS distance FROM candidates",
        ),
        "waterbody_targets": q(("wb_targets",), "SELECT wbody_id, waterbody_key FROM wb_targets"),
        "waterbody_pairs": q(("wb_pairs",), "SELECT observation_key, waterbody_key FROM wb_pairs"),
        "stream_xref_candidates": q(
            ("listed",),
            "SELECT observation_key, linear_feature_id, round(distance, 6) AS distance FROM listed",
        ),
        "match_tiers": q(("matched",), f"SELECT {tier_columns} FROM matched"),
        "match_summary": q(
            ("rounded",),
            "SELECT match_type, count(DISTINCT (blue_line_key, downstream_route_measure)) AS n_distinct_events,"
            " count(*) AS n_observations FROM rounded GROUP BY 1",
        ),
        "unmatched_obs": q(
            ("obs", "matched"),
            "SELECT observation_key, fish_observation_point_id, waterbody_type FROM obs"
            " WHERE observation_key NOT IN (SELECT observation_key FROM matched)",
        ),
        "unmatched_rollup": q(("obs", "matched", "reach", "species"), _unmatched(100_000)),
        "unmatched_rollup_in_parts": q(("obs", "matched", "reach", "species"), _unmatched(2)),
        "measure_clamp": q(
            ("rounded",),
            "SELECT observation_key, round(measure, 6) AS measure, downstream_route_measure FROM rounded",
        ),
        "observations": q(
            ("snapped",),
            "SELECT * EXCLUDE (distance_to_stream, geom_x, geom_y, geom_z),"
            " round(distance_to_stream, 6) AS distance_to_stream,"
            " round(geom_x, 6) AS geom_x, round(geom_y, 6) AS geom_y, round(geom_z, 6) AS geom_z FROM snapped",
        ),
        "locate_along_route": q(
            ("edges",),
            "SELECT event AS event_id, round(geom_x, 6) AS geom_x, round(geom_y, 6) AS geom_y,"
            " round(geom_z, 6) AS geom_z FROM ("
            + _located(
                f"SELECT e AS event, 354087611 + (e * 7) % n AS route, {measure_of} AS pos FROM"
                " (SELECT event_id AS e, (SELECT count(*) // 10 FROM orders) AS n FROM events)"
            )
            + ")",
        ),
        "elevation_on_line": q(
            ("edges", "streams"),
            "SELECT linear_feature_id, pos AS measure, round(CASE WHEN pos = m2 THEN z2"
            " ELSE z1 + (pos - m1) / (m2 - m1) * (z2 - z1) END) AS elevation FROM"
            " (SELECT e.*, s.downstream_route_measure + linear_feature_id % 140 AS pos FROM edges e"
            " JOIN streams s USING (linear_feature_id))"
            " WHERE m1 <= pos AND (pos < m2 OR (edge_no = 1 AND pos = m2))",
        ),
        "species_on_route": q(
            ("rounded", "obs"),
            "SELECT DISTINCT species_code FROM rounded JOIN obs USING (observation_key)"
            " WHERE blue_line_key = 354087619 AND downstream_route_measure < 900",
        ),
        "observations_with_stream": q(
            ("rounded", "obs", "streams"),
            "SELECT r.observation_key, s.gnis_name, s.gradient, s.stream_order FROM rounded r"
            " JOIN obs o ON o.observation_key = r.observation_key"
            " JOIN streams s ON s.linear_feature_id = r.linear_feature_id"
            " WHERE o.species_code = 'CL' AND r.watershed_group_code = 'GRP1'",
        ),
        "gradient_at_species": q(
            ("rounded", "obs", "streams"),
            "SELECT r.observation_key, s.gnis_name, s.gradient FROM rounded r"
            " JOIN obs o ON o.observation_key = r.observation_key"
            " JOIN streams s ON s.linear_feature_id = r.linear_feature_id"
            " WHERE o.species_code = 'VI' AND r.watershed_group_code = 'GRP3' AND s.edge_type = 1000",
        ),
        "elevation_at_species": q(
            ("rounded", "obs", "streams", "edges"),
            "SELECT r.observation_key, s.gradient, s.stream_order, round(CASE WHEN pos = m2 THEN z2"
            " ELSE z1 + (pos - m1) / (m2 - m1) * (z2 - z1) END) AS elevation"
            " FROM (SELECT *, downstream_route_measure AS pos FROM rounded) r"
            " JOIN obs o ON o.observation_key = r.observation_key"
            " JOIN streams s ON s.linear_feature_id = r.linear_feature_id"
            " JOIN edges e ON e.linear_feature_id = r.linear_feature_id"
            " WHERE o.species_code = 'CL' AND r.watershed_group_code = 'GRP2'"
            " AND m1 <= pos AND (pos < m2 OR (edge_no = 1 AND pos = m2))",
        ),
        "event_ids": q(
            (),
            "SELECT e AS event_id, (354087611 + (e * 7) % n + 1 - 354087611) * 10000000"
            f" + CAST(round_even({measure_of}, 0) AS BIGINT) AS fish_obsrvtn_event_id"
            " FROM (SELECT event_id AS e, (SELECT count(*) // 10 FROM orders) AS n FROM events)",
        ),
        "event_rollup": q(("cut_usual",), f"SELECT {event_text} FROM cut_usual"),
        "event_rollup_in_parts": q(("cut_small",), f"SELECT {event_text} FROM cut_small"),
        "event_explode": q(
            ("gathered", "source", "species", "streams"),
            "SELECT x.id AS fish_observation_point_id, x.fish_obsrvtn_event_id, x.linear_feature_id,"
            " s.wscode_ltree, s.localcode_ltree, x.blue_line_key, s.waterbody_key, x.downstream_route_measure,"
            " round(x.distance, 6) AS distance_to_stream, x.match_type, s.watershed_group_code, p.species_id,"
            " b.species_code, b.agency_id, CAST(b.observation_date AS VARCHAR) AS observation_date, b.agency_name,"
            " b.source, b.source_ref, b.activity_code, b.activity, b.life_stage_code, b.life_stage,"
            " b.acat_report_url, round(x.geom_z, 6) AS geom_z"
            " FROM (SELECT *, unnest(obs_ids) AS id, unnest(distances) AS distance, unnest(match_types) AS match_type"
            " FROM gathered) x JOIN streams s ON s.linear_feature_id = x.linear_feature_id"
            " JOIN source b ON b.fish_observation_point_id = x.id JOIN species p ON p.code = b.species_code",
        ),
        "unnest_arrays": q(
            (),
            "SELECT event_id, unnest(CASE WHEN event_id % 7 <> 0 THEN range(event_id % 4) END) AS n,"
            " unnest(CASE WHEN event_id % 5 <> 0 THEN list_transform(range(event_id % 3), lambda i: concat('v', i)) END)"
            " AS label FROM events",
        ),
        "events_with_species": q(
            ("cut_usual",),
            "SELECT fish_obsrvtn_event_id, part_no, array_to_string(obs_ids, ',') AS obs_ids FROM cut_usual"
            " WHERE list_has_any(species_ids, [499, 518])",
        ),
        "events_with_species_in_parts": q(
            ("cut_small",),
            "SELECT c.fish_obsrvtn_event_id, part_no, array_to_string(c.obs_ids, ',') AS obs_ids"
            " FROM cut_small c JOIN gathered g ON g.fish_obsrvtn_event_id = c.fish_obsrvtn_event_id"
            " WHERE list_has_any(g.species_ids, [499, 518])",
        ),
        "events_with_observation": q(
            ("cut_usual",),
            "SELECT fish_obsrvtn_event_id, part_no, array_to_string(species_codes, ',') AS species_codes FROM cut_usual"
            " WHERE list_contains(obs_ids, 391)",
        ),
    }
    # a round trip through a sink changes nothing
    out |= {"duplicates_csv": out["obs_duplicates"]}
    out["stored_events_with_species"] = out["events_with_species_in_parts"]
    out["stored_events_with_observation"] = out["events_with_observation"]
    out |= dict.fromkeys(("published_observations", "exported_observations"), out["observations"])
    for t in "abcde":
        out[f"tier_{t}"] = q((f"tier_{t}",), f"SELECT {tier_columns} FROM tier_{t}")
    return out
