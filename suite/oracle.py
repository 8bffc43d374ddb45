"""SQL for DuckDB that returns the same rows as the query of the same name.

Written from the definitions, not from the Spark plans: paths are cut by string
functions, components spread by recursive queries, resizes are joins to weight
tables, and the hash is XXH64 in 128-bit arithmetic.
"""

from __future__ import annotations

from suite.views import MANIFEST, REQUESTS, UPLOADS

# -- building blocks -----------------------------------------------------------------------

# XXH64 primes.
P1, P2, P3, P4 = 11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579
TWO64 = "18446744073709551616::UHUGEINT"


def _read(offset: int, count: int) -> str:
    """Little-endian integer from the characters of ``s``."""
    terms = [f"ascii(substr(s, {offset + i + 1}, 1))::UHUGEINT * {256**i}::UHUGEINT" for i in range(count)]
    return "(" + " + ".join(terms) + ")"


def _mul(a: str, b: int) -> str:
    return f"(({a}) * {b}::UHUGEINT % {TWO64})"


def _rotl(name: str, bits: int) -> str:
    return f"(({name} * {2**bits}::UHUGEINT % {TWO64}) + {name} // {2 ** (64 - bits)}::UHUGEINT)"


def hashed(source: str) -> str:
    """``source`` plus ``h``, XXH64 with seed 42 of ``image_id::42`` (68 ASCII bytes) as BIGINT."""
    start = [(42 + P1 + P2) % 2**64, (42 + P2) % 2**64, 42, (42 - P1) % 2**64]
    lanes = ["v1", "v2", "v3", "v4"]
    query = f"SELECT *, image_id || '::42' AS s, " + ", ".join(
        f"{value}::UHUGEINT AS {lane}" for value, lane in zip(start, lanes)
    ) + f", 0::UHUGEINT AS h FROM {source}"

    def replace(**columns: str) -> None:
        nonlocal query
        query = f"SELECT * REPLACE ({', '.join(f'{sql} AS {name}' for name, sql in columns.items())}) FROM ({query})"

    for stripe in (0, 32):
        replace(**{v: f"({v} + {_mul(_read(stripe + 8 * i, 8), P2)}) % {TWO64}" for i, v in enumerate(lanes)})
        replace(**{v: _mul(_rotl(v, 31), P1) for v in lanes})
    replace(h="(" + " + ".join(_rotl(v, bits) for v, bits in zip(lanes, (1, 7, 12, 18))) + f") % {TWO64}")
    replace(**{v: _mul(v, P2) for v in lanes})
    replace(**{v: _mul(_rotl(v, 31), P1) for v in lanes})
    for v in lanes:
        replace(h=f"({_mul(f'xor(h, {v})', P1)} + {P4}::UHUGEINT) % {TWO64}")
    replace(h=f"(h + 68::UHUGEINT) % {TWO64}")
    replace(h=f"xor(h, {_mul(_read(64, 4), P1)})")
    replace(h=f"({_mul(_rotl('h', 23), P2)} + {P3}::UHUGEINT) % {TWO64}")
    for shift, prime in ((33, P2), (29, P3), (32, 1)):
        replace(h=_mul(f"xor(h, h // {2**shift}::UHUGEINT)", prime))
    signed = f"(CASE WHEN h >= {2**63}::UHUGEINT THEN h::HUGEINT - {2**64}::HUGEINT ELSE h::HUGEINT END)::BIGINT"
    return f"SELECT * EXCLUDE (s, v1, v2, v3, v4) REPLACE ({signed} AS h) FROM ({query})"


def _pmod(n: int) -> str:
    return f"((h % {n}) + {n}) % {n}"


KEY = f"({_pmod(1000000)}) / 1000000.0"
SPLIT = f"CASE WHEN {KEY} < 0.7 THEN 'train' WHEN {KEY} < 0.85 THEN 'val' ELSE 'test' END"
SHARD = f"({_pmod(16)})::INT"

# Class directory, modality and class name of a path.
SUFFIX = "CASE WHEN ends_with(dir, 'T1C+') THEN 'T1C+' WHEN ends_with(dir, 'T1') THEN 'T1' WHEN ends_with(dir, 'T2') THEN 'T2' END"
ENRICHED = f"""
m AS ({MANIFEST}),
cut AS (SELECT *, string_split(path, '/') AS parts FROM m),
named AS (SELECT doc_id, path, length, parts[-2] AS dir, lower(string_split(parts[-1], '.')[-1]) AS ext, parts[-1] AS file FROM cut),
every AS (SELECT *, {SUFFIX} AS modality FROM named),
labelless AS (SELECT doc_id, sha256(path) AS image_id, path AS raw_path, length::BIGINT AS file_size, modality, ext, file,
  CASE WHEN modality IS NOT NULL AND substr(dir, length(dir) - length(modality), 1) = ' '
       THEN rtrim(substr(dir, 1, length(dir) - length(modality))) ELSE dir END AS pathology FROM every),
kept AS (SELECT * FROM labelless WHERE ext IN ('jpg', 'jpeg', 'png') AND NOT starts_with(file, '.')),
mapping AS (SELECT pathology, (row_number() OVER (ORDER BY pathology) - 1)::INT AS label_idx
  FROM (SELECT DISTINCT pathology FROM kept WHERE pathology <> ''))"""
SPLITTED = f"""{ENRICHED},
hashes AS ({hashed('kept')}),
parted AS (SELECT *, {SPLIT} AS split, {SHARD} AS shard_id FROM hashes)"""

# Images: one row per pixel, and the hex text of an image.
GRID = """
g AS (SELECT vec_id, label, CAST(floor((e::DOUBLE-lo)/(hi-lo)*255) AS INT) AS v, (i//8)::INT AS y, (i%8)::INT AS x
 FROM (SELECT vec_id, label, list_min(embedding)::DOUBLE lo, list_max(embedding)::DOUBLE hi,
              unnest(embedding) e, unnest(range(0,64)) i FROM embeddings))"""


def hex_of(value: str, order: str) -> str:
    return f"string_agg(printf('%02X', ({value})::INT), '' ORDER BY {order})"


def level(value: str) -> str:
    """Clip and truncate, after dropping noise below 1e-9."""
    return f"floor(round(greatest(least({value}, 255.0), 0.0), 9))"


def masks(thresholds: str) -> str:
    """``part`` (largest component) and ``mask`` (with holes filled) pixels per image and threshold."""
    return f"""
th AS (SELECT unnest([{thresholds}])::INT AS t),
fg AS (SELECT vec_id, t, y, x FROM g, th WHERE v > t),
r AS (SELECT vec_id, t, y, x, y*8+x AS l FROM fg
  UNION SELECT f.vec_id, f.t, f.y, f.x, r.l FROM r JOIN fg f ON f.vec_id = r.vec_id AND f.t = r.t AND abs(f.y-r.y)+abs(f.x-r.x) = 1),
comp AS (SELECT vec_id, t, y, x, min(l) AS c FROM r GROUP BY ALL),
sized AS (SELECT vec_id, t, c, count(*) AS n FROM comp GROUP BY ALL),
best AS (SELECT vec_id, t, c FROM sized QUALIFY row_number() OVER (PARTITION BY vec_id, t ORDER BY n DESC, c) = 1),
part AS (SELECT vec_id, t, y, x FROM comp JOIN best USING (vec_id, t, c)),
bg AS (SELECT g.vec_id, b.t, g.y, g.x FROM g JOIN best b USING (vec_id) ANTI JOIN part p ON p.vec_id = g.vec_id AND p.t = b.t AND p.y = g.y AND p.x = g.x),
o AS (SELECT vec_id, t, y, x FROM bg WHERE y IN (0, 7) OR x IN (0, 7)
  UNION SELECT b.vec_id, b.t, b.y, b.x FROM o JOIN bg b ON b.vec_id = o.vec_id AND b.t = o.t AND abs(b.y-o.y)+abs(b.x-o.x) = 1),
mask AS (SELECT g.vec_id, b.t, g.y, g.x FROM g JOIN best b USING (vec_id) ANTI JOIN o ON o.vec_id = g.vec_id AND o.t = b.t AND o.y = g.y AND o.x = g.x)"""


# Grey levels after the percentile stretch inside the mask (whole image without one), background 0.
STRETCHED = f"""
base AS (SELECT g.*, th.t, b.vec_id IS NOT NULL AS found, m.vec_id IS NOT NULL AS inside FROM g CROSS JOIN th
  LEFT JOIN best b ON b.vec_id = g.vec_id AND b.t = th.t
  LEFT JOIN mask m ON m.vec_id = g.vec_id AND m.t = th.t AND m.y = g.y AND m.x = g.x),
bounds AS (SELECT vec_id, t, quantile_cont(v::DOUBLE, 0.01) AS lo, quantile_cont(v::DOUBLE, 0.99) AS hi
  FROM base WHERE inside OR NOT found GROUP BY ALL),
stretched AS (SELECT base.*, CASE WHEN found AND NOT inside THEN 0.0 WHEN hi > lo
  THEN {level('greatest(least((v - lo) / (hi - lo), 1.0), 0.0) * 255.0')} ELSE v END AS p FROM base JOIN bounds USING (vec_id, t))"""


def weights(name: str, sizes: str) -> str:
    """Table of ``(n, m, i, j, w)``: Lanczos weights from n to m pixels for the pairs ``(n, m)`` of ``sizes``."""
    return f"""
{name}_at AS (SELECT n, m, i, (i + 0.5) * n / m AS c, greatest(n / m, 1.0) AS f
  FROM (SELECT n::DOUBLE AS n, m::DOUBLE AS m, unnest(range(0, m))::DOUBLE AS i FROM ({sizes}))),
{name}_t AS (SELECT n, m, i, j, (j - c + 0.5) / f AS t FROM (SELECT *,
  unnest(range(greatest(0, floor(c - 3 * f + 0.5))::BIGINT, least(n, floor(c + 3 * f + 0.5))::BIGINT)) AS j FROM {name}_at)),
{name}_l AS (SELECT n, m, i, j, CASE WHEN t = 0 THEN 1.0 WHEN abs(t) >= 3 THEN 0.0
  ELSE sin(pi() * t) / (pi() * t) * sin(pi() * t / 3) / (pi() * t / 3) END AS l FROM {name}_t),
{name} AS (SELECT n::INT AS n, m::INT AS m, i::INT AS i, j::INT AS j, l / sum(l) OVER (PARTITION BY n, m, i) AS w FROM {name}_l)"""


def pass_level(total: str) -> str:
    return f"greatest(least(floor(round({total}, 9) + 0.5), 255.0), 0.0)"


def resized(width: int, height: int, cols: int, rows: int, window: tuple[int, int, int, int] = (0, 0, 8, 8)) -> str:
    """Rows of one resize: the window (top, left, rows, cols) to rows x cols, centred on black."""
    top, left, tall, wide = window
    dy, dx = (height - rows) // 2, (width - cols) // 2
    return f"""
SELECT vec_id, {width} AS new_width, {height} AS new_height, {hex_of('coalesce(p, 0)', 'cy, cx')} AS resized
FROM (SELECT vec_id, cy::INT AS cy, cx::INT AS cx FROM (SELECT DISTINCT vec_id FROM g), range({height}) a(cy), range({width}) b(cx)) canvas
LEFT JOIN (
  SELECT vec_id, wv.i + {dy} AS cy, h.x + {dx} AS cx, {pass_level('sum(h.p * wv.w)')} AS p
  FROM (SELECT vec_id, y - {top} AS y, wh.i AS x, {pass_level('sum(v * wh.w)')} AS p
        FROM g JOIN lz wh ON wh.j = g.x - {left} AND wh.n = {wide} AND wh.m = {cols}
        WHERE y BETWEEN {top} AND {top + tall - 1} GROUP BY ALL) h
  JOIN lz wv ON wv.j = h.y AND wv.n = {tall} AND wv.m = {rows} GROUP BY ALL) USING (vec_id, cy, cx)
GROUP BY vec_id"""


def sizes(*pairs: tuple[int, int]) -> str:
    return "SELECT * FROM (VALUES " + ", ".join(f"({n}, {m})" for n, m in pairs) + ") s(n, m)"


# Class-mean model: pixels scaled to 0..1, means of the training split, softmax of minus squared distance.
MODEL = f"""{GRID},
ids AS (SELECT DISTINCT vec_id, label, sha256(vec_id::VARCHAR) AS image_id FROM g),
hashes AS ({hashed('ids')}),
img AS (SELECT vec_id, label, image_id, {SPLIT} AS split FROM hashes),
px AS (SELECT g.vec_id, g.label, img.image_id, img.split, y*8+x AS i, v, v / 255.0 AS p FROM g JOIN img USING (vec_id)),
means AS (SELECT label AS k, i, avg(p) AS m FROM px WHERE split = 'train' GROUP BY ALL),
dist AS (SELECT vec_id, k, sum((p - m) * (p - m)) AS d FROM px JOIN means USING (i) GROUP BY ALL),
probs AS (SELECT vec_id, k, exp(-d) / sum(exp(-d)) OVER (PARTITION BY vec_id) AS pr FROM dist),
ranked AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY round(pr, 12) DESC, k) AS rk FROM probs),
err AS (SELECT px.*, m, (p - m) * (p - m) AS e FROM px JOIN means ON means.i = px.i AND k = 0),
peaks AS (SELECT vec_id, max(e) AS max_error, avg(e) AS mean_error FROM err GROUP BY ALL),
cal AS (SELECT peaks.* FROM peaks JOIN img USING (vec_id) WHERE label = 0 AND split IN ('train', 'val')),
thr AS (SELECT max(max_error) AS strict, quantile_cont(max_error, 0.99) AS p99, quantile_cont(max_error, 0.95) AS p95 FROM cal)"""

# Class names by index, as the queries use them.
NAMES = (
    "['Astrocitoma','Carcinoma','Ependimoma','Ganglioglioma','Germinoma','Glioblastoma','Granuloma','Meduloblastoma',"
    "'Meningioma','Neurocitoma','Oligodendroglioma','Papiloma','Schwannoma','Tuberculoma','_NORMAL']"
)


def name_of(index: str) -> str:
    return f"coalesce({NAMES}[{index} + 1], 'idx=' || {index})"


STATUS = f"""
rq AS ({REQUESTS}),
last AS (SELECT request_id, status, ts AS updated_at FROM rq QUALIFY row_number() OVER (PARTITION BY request_id ORDER BY ts DESC, event_id DESC) = 1),
modes AS (SELECT request_id, threshold_mode FROM rq WHERE threshold_mode IS NOT NULL QUALIFY row_number() OVER (PARTITION BY request_id ORDER BY ts DESC, event_id DESC) = 1),
customs AS (SELECT request_id, custom_threshold FROM rq WHERE custom_threshold IS NOT NULL QUALIFY row_number() OVER (PARTITION BY request_id ORDER BY ts DESC, event_id DESC) = 1),
merged AS (SELECT * FROM last LEFT JOIN modes USING (request_id) LEFT JOIN customs USING (request_id)),
opened AS (SELECT *, CASE WHEN substr(request_id, 2)::INT % 7 = 0 THEN '/given/' || request_id END AS given,
  substr(request_id, 2)::INT % 5 = 0 AS has_silver FROM merged)"""

ORACLE: dict[str, str] = {}

# -- manifest ------------------------------------------------------------------------------

ORACLE["manifest_scan_filter"] = f"WITH {ENRICHED} SELECT doc_id, raw_path AS path, file_size AS length FROM kept"
ORACLE["manifest_row_counts"] = (
    f"WITH {ENRICHED} SELECT (SELECT count(*) FROM labelless) AS rows_listed, (SELECT count(*) FROM kept) AS rows_kept"
)
ORACLE["manifest_enrich"] = f"WITH {ENRICHED} SELECT image_id, raw_path, pathology, modality, file_size FROM kept"
ORACLE["label_mapping"] = f"WITH {ENRICHED} SELECT pathology, label_idx FROM mapping ORDER BY label_idx"
ORACLE["manifest_labelled"] = f"""WITH {ENRICHED}
SELECT image_id, raw_path, pathology, label_idx, modality, file_size FROM kept LEFT JOIN mapping USING (pathology)"""
ORACLE["uri_paths"] = f"""WITH m AS ({MANIFEST}), b AS (SELECT doc_id, substr(path, 6) AS p FROM m),
enc AS (SELECT doc_id, p, replace(replace(p, ' ', '%20'), 'Class', 'Cl%61ss') AS e FROM b),
spelled AS (
  SELECT doc_id, 'short' AS spelling, 'file:' || e AS uri, p AS local FROM enc UNION ALL
  SELECT doc_id, 'long', 'file://' || e, p FROM enc UNION ALL
  SELECT doc_id, 'host', 'file://host' || e, '//host' || p FROM enc UNION ALL
  SELECT doc_id, 'bare', e, e FROM enc UNION ALL
  SELECT doc_id, 'stray', 'file:' || e || '%zz%', p || '%zz%' FROM enc)
SELECT doc_id, spelling, local, replace(uri, '/', '_') AS partition_value, NULL::VARCHAR AS request_id FROM spelled"""

# -- splits, shards, summary ---------------------------------------------------------------

ORACLE["split_assignment"] = f"""WITH {SPLITTED}
SELECT image_id, split, 's1' AS split_id, 42 AS split_seed, '0.7000/0.1500/0.1500' AS split_ratios FROM parted"""
ORACLE["split_counts"] = f"""WITH {SPLITTED}
SELECT s.split, count(p.split) AS rows, (SELECT count(*) FROM parted) AS rows_total
FROM (VALUES ('train'), ('val'), ('test')) s(split) LEFT JOIN parted p ON p.split = s.split GROUP BY s.split"""
ORACLE["split_label_counts"] = f"""WITH {SPLITTED}
SELECT split, label_idx, pathology, modality, count(*) AS rows FROM parted LEFT JOIN mapping USING (pathology) GROUP BY ALL"""
ORACLE["split_registry_names"] = """
SELECT o_orderkey, coalesce(given, 'split_seed' || seed || '_r' || (100 - 2 * pct) || '_' || pct || '_' || pct || '_' || t) AS split_id,
  coalesce(given, 'training_tfrecord_seed' || seed || '_n' || n || '_' || t) AS export_id
FROM (SELECT o_orderkey, CASE o_orderstatus WHEN 'P' THEN 'given' END AS given, o_custkey AS seed, (o_orderkey % 3 + 1) * 5 AS pct,
  o_orderkey % 64 + 1 AS n, strftime(o_orderdate, '%Y%m%dT%H%M%SZ') AS t FROM orders)"""
ORACLE["shard_assignment"] = f"""WITH {SPLITTED}
SELECT image_id, split, 's1' AS split_id, shard_id, 'e1' AS export_id, 42 AS shard_seed, 16 AS n_shards FROM parted"""
ORACLE["wide_key_split"] = f"""WITH keys AS (SELECT sha256(l_orderkey || '-' || l_linenumber) AS image_id FROM lineitem),
hashes AS ({hashed('keys')})
SELECT {SPLIT} AS split, {SHARD} AS shard_id, count(*) AS rows FROM hashes GROUP BY ALL"""
ORACLE["export_parquet_shards"] = f"""WITH {SPLITTED},
f AS (SELECT split, shard_id, count(*) AS rows_written FROM parted GROUP BY ALL)
SELECT 'e1' AS export_id, split, shard_id, 'split=' || split || '/shard_id=' || shard_id AS folder, rows_written,
  sum(rows_written) OVER (PARTITION BY split)::BIGINT AS rows_in_split, count(*) OVER (PARTITION BY split) AS files FROM f"""
ORACLE["export_example_shards"] = f"""WITH {SPLITTED}
SELECT image_id, split, 's1' AS split_id, (doc_id % 20)::INT AS label_idx, shard_id, octet_length(encode(text))::INT AS image_bytes_len
FROM parted JOIN documents USING (doc_id)"""
ORACLE["export_reconcile"] = f"""WITH {SPLITTED}
SELECT split, count(*) AS input_count, count(*) FILTER (split <> 'test' AND modality IS DISTINCT FROM 'T2') AS output_count
FROM parted GROUP BY split HAVING input_count <> output_count"""
ORACLE["split_files"] = f"""WITH {SPLITTED}
SELECT DISTINCT split, printf('/data/e1/split=%s/shard_id=%d/part-%05d.tfrecord', split, shard_id, shard_id) AS file FROM parted ORDER BY ALL"""
ORACLE["dataset_summary"] = f"""WITH {SPLITTED},
files AS (SELECT split, count(DISTINCT shard_id) AS files FROM parted WHERE modality IS DISTINCT FROM 'T2' GROUP BY split),
sizes AS (SELECT split, count(*) AS n FROM parted GROUP BY split)
SELECT 'e1' AS export_id, 42 AS seed, 16 AS n_shards, (SELECT count(*) FROM parted) AS rows_total,
  (SELECT sum(files) FROM files)::BIGINT AS files_total, (SELECT count(*) FROM mapping)::INT AS distinct_labels, split,
  any_value(sizes.n) AS rows_in_split, any_value(files.files) AS files_in_split, label_idx, pathology, count(*) AS rows,
  224 AS image_height, 224 AS image_width, 1 AS channels
FROM parted JOIN mapping USING (pathology) JOIN sizes USING (split) JOIN files USING (split) GROUP BY split, label_idx, pathology"""
ORACLE["label_inventory"] = f"WITH {ENRICHED} SELECT label_idx, pathology FROM mapping ORDER BY label_idx"
ORACLE["distinct_labels"] = f"""WITH {ENRICHED}
SELECT count(DISTINCT pathology) + max((ext = 'txt')::INT) AS distinct_labels, count(DISTINCT CASE WHEN ext <> 'txt' THEN pathology END) AS distinct_non_null_labels
FROM labelless"""
ORACLE["label_lookup"] = f"""WITH {SPLITTED},
counts AS (SELECT split, label_idx, count(*) AS n FROM parted JOIN mapping USING (pathology) GROUP BY ALL),
wanted AS (SELECT split, label_idx FROM (VALUES ('train'), ('val'), ('test'), ('holdout')) s(split),
  (SELECT label_idx FROM mapping UNION ALL SELECT max(label_idx) + 1 FROM mapping)),
found AS (SELECT w.split, w.label_idx, CASE WHEN w.split IN ('train', 'val', 'test') THEN coalesce(n, 0) END AS rows
  FROM wanted w LEFT JOIN counts c ON c.split = w.split AND c.label_idx = w.label_idx)
SELECT split, label_idx, rows, (SELECT label_idx FROM mapping WHERE pathology = '_NORMAL') AS normal_idx, NULL::INT AS absent_idx,
  (SELECT count(*) FROM mapping)::INT AS num_classes, CASE WHEN rows IS NULL THEN 1 ELSE greatest(1, ceil(rows / 4)) END::BIGINT AS steps FROM found"""
ORACLE["registry_latest"] = """
WITH e AS (SELECT event_type AS version, CASE WHEN value > 250 THEN 2 WHEN value > 100 THEN 1 ELSE 0 END AS tier, ts, event_id FROM events),
v AS (SELECT version, tier, max(ts) AS generated_at, count(*) AS rows_written, arg_max(event_id, (ts, event_id)) AS last FROM e GROUP BY ALL),
kept AS (SELECT * FROM v QUALIFY row_number() OVER (PARTITION BY version ORDER BY tier DESC) = 1)
SELECT version, tier, generated_at, rows_written, '/out/' || last AS output_path,
  (SELECT '/out/' || arg_max(last, generated_at) FROM kept) AS current_output_path FROM kept"""

# -- samples and statistics ----------------------------------------------------------------

ORACLE["registry_appended"] = """
WITH e AS (SELECT event_type AS version, CASE WHEN value > 250 THEN 2 WHEN value > 100 THEN 1 ELSE 0 END AS tier, ts, event_id FROM events),
v AS (SELECT version, tier, max(ts) AS generated_at, count(*) AS rows_written, arg_max(event_id, (ts, event_id)) AS last FROM e GROUP BY ALL)
SELECT version, tier, generated_at, rows_written, '/out/' || last AS output_path,
  '/out/' || (SELECT arg_max(last, generated_at) FROM v) AS current_output_path FROM v"""
ORACLE["summary_stored"] = ORACLE["dataset_summary"]
ORACLE["files_in_order"] = "SELECT l_returnflag, count(*) AS rows, 1::BIGINT AS files, 0::BIGINT AS out_of_order FROM lineitem GROUP BY l_returnflag"
ORACLE["sample_per_class"] = f"""WITH {ENRICHED} SELECT image_id, pathology FROM kept
QUALIFY row_number() OVER (PARTITION BY pathology ORDER BY md5(image_id || '::42'), image_id) <= 5"""
ORACLE["sample_n"] = f"WITH {ENRICHED} SELECT image_id, pathology FROM kept ORDER BY md5(image_id || '::42'), image_id LIMIT 100"
ORACLE["class_counts"] = f"WITH {ENRICHED} SELECT pathology, count(*) AS images FROM kept GROUP BY ALL"
ORACLE["class_balance"] = f"""WITH {ENRICHED}, c AS (SELECT count(*) AS n FROM kept GROUP BY pathology)
SELECT round(avg(n), 6) AS mean_images, round(median(n), 6) AS median_images, min(n) AS min_images, max(n) AS max_images,
  round(stddev_samp(n), 6) AS std_images FROM c"""
ORACLE["image_dims"] = """
WITH d AS (SELECT 'width' AS dimension, (n_chars % 640)::DOUBLE AS v FROM documents UNION ALL SELECT 'height', (n_chars % 480)::DOUBLE FROM documents)
SELECT dimension, count(*)::DOUBLE AS dim_count, round(avg(v), 6) AS dim_mean, round(stddev_samp(v), 6) AS dim_std, min(v) AS dim_min,
  round(quantile_cont(v, 0.25), 6) AS dim_p25, round(quantile_cont(v, 0.5), 6) AS dim_p50, round(quantile_cont(v, 0.75), 6) AS dim_p75,
  max(v) AS dim_max FROM d GROUP BY dimension"""
ORACLE["best_epoch"] = """
WITH h AS (SELECT event_type AS run, event_id AS epoch, value AS metric,
  row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS nth,
  max(value) OVER (PARTITION BY event_type ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM events),
i AS (SELECT *, max(CASE WHEN before IS NULL OR metric > before THEN nth END) OVER (PARTITION BY run ORDER BY epoch) AS improved FROM h),
s AS (SELECT run, min(epoch) FILTER (nth - improved >= 50) AS stopped_epoch FROM i GROUP BY run),
top AS (SELECT i.run, i.epoch, i.metric, s.stopped_epoch FROM i JOIN s USING (run) WHERE s.stopped_epoch IS NULL OR epoch <= s.stopped_epoch)
SELECT run, arg_min(epoch, (-metric, epoch)) AS best_epoch, max(metric) AS best_metric, count(*) AS epochs_run, any_value(stopped_epoch) AS stopped_epoch, 'max' AS mode
FROM top GROUP BY run
UNION ALL SELECT event_type, arg_min(event_id, (value, event_id)), min(value), count(*), NULL, 'min' FROM events GROUP BY event_type"""

# -- image kernels -------------------------------------------------------------------------

ORACLE["gray_from_bgr"] = f"""WITH {GRID}, s AS (SELECT vec_id, y*8+x AS i, v FROM g)
SELECT vec_id, {hex_of('(19595 * r.v + 38470 * gr.v + 7471 * b.v + 32768) // 65536', 'b.i')} AS pixels
FROM s b JOIN s gr USING (vec_id) JOIN s r USING (vec_id) WHERE gr.i = (b.i + 1) % 64 AND r.i = (b.i + 2) % 64 GROUP BY vec_id"""
ORACLE["foreground_mask"] = f"""WITH RECURSIVE {GRID}, {masks('12, 100, 128, 255')}
SELECT g.vec_id, th.t AS threshold,
  CASE WHEN count(b.c) > 0 THEN {hex_of('(p.y IS NOT NULL)', 'g.y, g.x')} END AS component,
  CASE WHEN count(b.c) > 0 THEN {hex_of('(m.y IS NOT NULL)', 'g.y, g.x')} END AS mask
FROM g CROSS JOIN th LEFT JOIN best b ON b.vec_id = g.vec_id AND b.t = th.t
LEFT JOIN part p ON p.vec_id = g.vec_id AND p.t = th.t AND p.y = g.y AND p.x = g.x
LEFT JOIN mask m ON m.vec_id = g.vec_id AND m.t = th.t AND m.y = g.y AND m.x = g.x
GROUP BY g.vec_id, th.t"""
BOXES = """
mg AS (SELECT unnest([{margins}])::INT AS margin),
box AS (SELECT vec_id, margin, greatest(min(y) - margin, 0) AS top, least(max(y) + margin + 1, 8) AS bottom,
  greatest(min(x) - margin, 0) AS lft, least(max(x) + margin + 1, 8) AS rgt FROM mask CROSS JOIN mg GROUP BY vec_id, margin)"""
ORACLE["foreground_crop"] = f"""WITH RECURSIVE {GRID}, {masks('128')}, {BOXES.format(margins='1, 4')}
SELECT g.vec_id, margin, {hex_of('v', 'y, x')} AS prepared, any_value(bottom - top)::INT AS prepared_height, any_value(rgt - lft)::INT AS prepared_width
FROM g JOIN box USING (vec_id) WHERE y >= top AND y < bottom AND x >= lft AND x < rgt GROUP BY g.vec_id, margin"""
ORACLE["normalize_mask"] = f"""WITH RECURSIVE {GRID}, {masks('100, 255')}, {STRETCHED}
SELECT vec_id, t AS threshold, {hex_of('p', 'y, x')} AS prepared FROM stretched GROUP BY vec_id, t"""
ORACLE["resize_stretch"] = f"WITH {GRID}, {weights('lz', sizes((8, 4), (8, 6), (8, 12), (8, 10)))}" + " UNION ALL ".join(
    resized(w, h, w, h) for w, h in ((4, 4), (6, 6), (12, 10))
)
# 6x3 has ratio 2: rows int(8 / 2) = 4 from 2; 3x5 has ratio 0.6: columns int(8 * 0.6) = 4 from 2
ORACLE["resize_center_crop"] = f"WITH {GRID}, {weights('lz', sizes((8, 6), (4, 3), (8, 5)))}" + resized(6, 3, 6, 3, (2, 0, 4, 8)) + " UNION ALL " + resized(3, 5, 3, 5, (0, 2, 8, 4))
# 6x4: a square fits as 4x4; 12x10: already fits
ORACLE["resize_keep_aspect_pad"] = f"WITH {GRID}, {weights('lz', sizes((8, 4), (8, 8)))}" + resized(6, 4, 4, 4) + " UNION ALL " + resized(12, 10, 8, 8)

# Fit of (w, h) into 6x4: unchanged when it fits, else bound by the tighter side, the other side rounded
# to the nearer aspect.
FITTED = """
dims AS (SELECT vec_id, top, lft, (rgt - lft)::INT AS w, (bottom - top)::INT AS h FROM box),
aspects AS (SELECT *, w::DOUBLE / h AS a FROM dims),
fitted AS (SELECT *, CASE WHEN w <= 6 AND h <= 4 THEN w WHEN 6.0 / 4 >= a THEN
    greatest(CASE WHEN abs(a - floor(4 * a) / 4) <= abs(a - ceil(4 * a) / 4) THEN floor(4 * a) ELSE ceil(4 * a) END, 1) ELSE 6 END::INT AS cols,
  CASE WHEN w <= 6 AND h <= 4 THEN h WHEN 6.0 / 4 >= a THEN 4 ELSE
    greatest(CASE WHEN floor(6 / a) = 0 THEN 0 WHEN abs(a - 6 / floor(6 / a)) <= abs(a - 6 / ceil(6 / a)) THEN floor(6 / a) ELSE ceil(6 / a) END, 1) END::INT AS rows
  FROM aspects)"""
ORACLE["silver_transform"] = f"""WITH RECURSIVE {GRID}, {masks('128')}, {STRETCHED}, {BOXES.format(margins='1')}, {FITTED},
{weights('lz', 'SELECT n, m FROM range(1, 9) a(n), range(1, 9) b(m)')},
wide AS (SELECT s.vec_id, s.y - f.top AS y, wh.i AS x, {pass_level('sum(s.p * wh.w)')} AS p FROM stretched s JOIN fitted f USING (vec_id)
  JOIN lz wh ON wh.j = s.x - f.lft AND wh.n = f.w AND wh.m = f.cols WHERE s.y >= f.top AND s.y < f.top + f.h GROUP BY s.vec_id, s.y, f.top, wh.i),
small AS (SELECT f.vec_id, wv.i + (4 - f.rows) // 2 AS cy, wide.x + (6 - f.cols) // 2 AS cx, {pass_level('sum(wide.p * wv.w)')} AS p
  FROM wide JOIN fitted f USING (vec_id) JOIN lz wv ON wv.j = wide.y AND wv.n = f.h AND wv.m = f.rows GROUP BY f.vec_id, wv.i, f.rows, wide.x, f.cols),
canvas AS (SELECT vec_id, label, cy::INT AS cy, cx::INT AS cx FROM (SELECT DISTINCT vec_id, label FROM g), range(4) a(cy), range(6) b(cx))
SELECT sha256(vec_id::VARCHAR) AS image_id, 'file:/raw/' || vec_id || '.png' AS raw_path, any_value(label) AS label_idx,
  {hex_of('coalesce(p, 0)', 'cy, cx')} AS processed_bytes, 24::BIGINT AS processed_file_size, 8 AS orig_width, 8 AS orig_height, 6 AS new_width,
  4 AS new_height, 1 AS channels, 'v1' AS transform_version, NULL::VARCHAR AS error
FROM canvas LEFT JOIN small USING (vec_id, cy, cx) GROUP BY vec_id"""
ORACLE["shape_check"] = """
SELECT vec_id, CASE label WHEN 3 THEN 'expected 8x8 grey pixels, got 60 bytes' WHEN 5 THEN 'expected 8x8 grey pixels, got 0 bytes' END AS error
FROM embeddings"""

# -- models and scores ---------------------------------------------------------------------

ORACLE["class_means"] = f"""WITH {MODEL}
SELECT k AS label_idx, (SELECT count(*) FROM img WHERE label = k AND split = 'train') AS images, round(avg(m), 6) AS brightness,
  round(max(CASE WHEN i = 9 THEN m END), 6) AS pixel_9 FROM means GROUP BY k"""
ORACLE["error_maps"] = f"""WITH {MODEL}
SELECT vec_id, {hex_of(level('m * 255.0'), 'i')} AS reconstruction, {hex_of(level('e / max_error * 255.0'), 'i')} AS error_map
FROM err JOIN peaks USING (vec_id) GROUP BY vec_id"""
ORACLE["overlay"] = f"""WITH {MODEL},
rgb AS (SELECT vec_id, i, max_error > 0.25 AS shown, CASE WHEN e > 0.25 THEN {level('v * 0.5 + 0.5 * (e / max_error) * 255.0')} ELSE v END AS r,
  CASE WHEN e > 0.25 THEN {level('v * 0.5')} ELSE v END AS gb FROM err JOIN peaks USING (vec_id))
SELECT vec_id, CASE WHEN any_value(shown) THEN string_agg(printf('%02X%02X%02X', r::INT, gb::INT, gb::INT), '' ORDER BY i) END AS anomaly_overlay
FROM rgb GROUP BY vec_id"""
ORACLE["saliency"] = f"""WITH {MODEL},
best AS (SELECT vec_id, k AS c, pr AS top FROM ranked WHERE rk = 1),
grad AS (SELECT b.vec_id, mc.i, sum(q.pr * 2 * (mc.m - mk.m)) * any_value(b.top) AS d
  FROM best b JOIN probs q USING (vec_id) JOIN means mk ON mk.k = q.k JOIN means mc ON mc.k = b.c AND mc.i = mk.i GROUP BY ALL),
heat AS (SELECT px.vec_id, px.i, px.v, greatest(d * p, 0.0) AS h FROM grad JOIN px USING (vec_id, i)),
scaled AS (SELECT *, CASE WHEN max(h) OVER w > 0 THEN h / max(h) OVER w ELSE h END AS s FROM heat WINDOW w AS (PARTITION BY vec_id)),
red AS (SELECT *, {level('s * 255.0')} AS hot FROM scaled)
SELECT vec_id, {hex_of('hot', 'i')} AS gradcam,
  string_agg(printf('%02X%02X%02X', {level('0.65 * v + 0.35 * hot')}::INT, {level('0.65 * v')}::INT, {level('0.65 * v')}::INT), '' ORDER BY i) AS gradcam_overlay
FROM red GROUP BY vec_id"""
ORACLE["classify_topk"] = f"""WITH {MODEL}, b AS (SELECT vec_id, k AS c, pr AS top FROM ranked WHERE rk = 1)
SELECT vec_id, c AS classifier_pred_idx, {name_of('c')} AS classifier_pred_label, round(top, 6) AS classifier_confidence,
  (rk - 1)::INT AS rank, k AS label_idx, {name_of('k')} AS label_name, round(pr, 6) AS probability
FROM ranked JOIN b USING (vec_id) WHERE rk <= 5"""
ORACLE["classifier_eval"] = f"""WITH {MODEL}
SELECT count(*) AS rows, round(avg((r.k = img.label)::INT), 6) AS accuracy, round(avg(-ln(greatest(p.pr, 1e-7))), 6) AS loss
FROM img JOIN ranked r ON r.vec_id = img.vec_id AND r.rk = 1 JOIN probs p ON p.vec_id = img.vec_id AND p.k = img.label WHERE split = 'test'"""
ORACLE["image_error_stats"] = f"WITH {MODEL} SELECT vec_id, round(max_error, 6) AS max_error, round(mean_error, 6) AS mean_error FROM peaks"
ORACLE["threshold_calibration"] = f"""WITH {MODEL}
SELECT round(max(max_error), 6) AS threshold_strict, round(quantile_cont(max_error, 0.99), 6) AS threshold_p99,
  round(quantile_cont(max_error, 0.95), 6) AS threshold_p95, count(*) AS normal_images_evaluated,
  round(avg(max_error), 6) AS max_pixel_error_mean, round(stddev_pop(max_error), 6) AS max_pixel_error_std,
  round(avg(mean_error), 6) AS mean_pixel_error_mean, round(stddev_pop(mean_error), 6) AS mean_pixel_error_std,
  0 AS normal_label_idx, '_NORMAL' AS normal_label_name, 8 AS image_height, 8 AS image_width FROM cal"""
ORACLE["anomaly_scores"] = f"""WITH {MODEL},
lim AS (SELECT unnest(['strict', 'p99', 'p95', 'custom']) AS mode, unnest([strict, p99, p95, 0.25]) AS t FROM thr),
hits AS (SELECT vec_id, mode, t, count(*) FILTER (e > t) AS n FROM err CROSS JOIN lim GROUP BY ALL)
SELECT vec_id, mode, round(max_error, 6) AS max_error, round(t, 6) AS anomaly_threshold, n > 0 AS anomaly_is_detected, n AS anomalous_pixel_count,
  round(n / 64.0, 6) AS anomaly_ratio, CASE WHEN n > 0 THEN 64::BIGINT END AS total_pixels FROM hits JOIN peaks USING (vec_id)"""
PREDICTED = f"""{MODEL},
hits AS (SELECT vec_id, max(e) AS max_error, any_value(p95) AS t, count(*) FILTER (e > p95) AS n FROM err CROSS JOIN thr GROUP BY vec_id),
tops AS (SELECT vec_id, string_agg(k::VARCHAR, ',' ORDER BY rk) AS topk_labels FROM ranked WHERE rk <= 3 GROUP BY vec_id),
pred AS (SELECT img.vec_id, image_id, label AS label_idx, k AS classifier_pred_idx, pr, max_error, t, n, topk_labels,
  CASE WHEN n > 0 THEN '/out/artifacts/' || image_id || '_anomaly_overlay.png' END AS over_path
  FROM img JOIN ranked r ON r.vec_id = img.vec_id AND rk = 1 JOIN hits ON hits.vec_id = img.vec_id JOIN tops ON tops.vec_id = img.vec_id)"""
ORACLE["predictions"] = f"""WITH {PREDICTED}
SELECT NULL::VARCHAR AS request_id, image_id, 'file:/raw/' || vec_id || '.png' AS raw_path, NULL::VARCHAR AS pathology, label_idx,
  'v1' AS transform_version, classifier_pred_idx, {name_of('classifier_pred_idx')} AS classifier_pred_label, round(pr, 6) AS classifier_confidence,
  round(max_error, 6) AS anomaly_max_error, round(t, 6) AS anomaly_threshold, n > 0 AS anomaly_is_detected, n AS anomalous_pixel_count,
  round(n / 64.0, 6) AS anomaly_ratio, '/out/artifacts/' || image_id || '_reconstruction.png' AS reconstruction_path,
  '/out/artifacts/' || image_id || '_error_map.png' AS error_map_path, over_path AS anomaly_overlay_path, NULL::VARCHAR AS gradcam_path,
  NULL::VARCHAR AS gradcam_overlay_path, topk_labels,
  coalesce(over_path, '/req/artifacts/' || image_id || '_anomaly_overlay.png') AS shown_anomaly_overlay_path,
  '/req/artifacts/' || image_id || '_gradcam.png' AS shown_gradcam_path FROM pred"""

# -- requests ------------------------------------------------------------------------------

ORACLE["latest_status"] = f"WITH {STATUS} SELECT request_id, status, updated_at FROM last"
ORACLE["status_merge"] = f"WITH {STATUS} SELECT request_id, status, updated_at, threshold_mode, custom_threshold FROM merged"
ORACLE["pending_requests"] = f"""WITH {STATUS}, up AS ({UPLOADS}),
files AS (SELECT string_split(path, '/')[3] AS request_id, path, length FROM up),
per AS (SELECT request_id, count(*) AS n, min(path) AS path, any_value(length) AS length FROM files GROUP BY request_id)
SELECT o.request_id, CASE WHEN n = 1 THEN sha256(path) END AS image_id, CASE WHEN n = 1 THEN path END AS raw_path, NULL::VARCHAR AS pathology,
  NULL::INT AS label_idx, NULL::VARCHAR AS modality, CASE WHEN n = 1 THEN length END AS file_size,
  CASE WHEN n IS NULL THEN 'no raw image found' WHEN n > 1 THEN 'expected exactly one raw image, found ' || n END AS error,
  n IS NOT NULL AND given IS NULL AND NOT has_silver AS to_build
FROM opened o LEFT JOIN per USING (request_id) WHERE status = 'pending' AND o.request_id <> 'templates'"""
ORACLE["request_settings"] = f"""WITH {STATUS}, h AS (SELECT *, '/requests/' || request_id AS home FROM opened)
SELECT request_id, 5 AS top_k, coalesce(threshold_mode, 'strict') AS threshold_mode, custom_threshold, true AS write_visual_artifacts,
  'local[1]' AS master, 1 AS partitions, '' AS partition_by, 'classification,anomaly_autoencoder' AS enabled_outputs,
  CASE WHEN given IS NOT NULL THEN given WHEN has_silver THEN home || '/manifest_silver.parquet' ELSE '/base/silver.parquet' END AS input_manifest,
  home || '/raw' AS raw_dir, home || '/metadata.json' AS metadata_path, home || '/status.json' AS status_path,
  home || '/manifest_bronze.parquet' AS manifest_bronze_path, home || '/manifest_silver.parquet' AS manifest_silver_path,
  home || '/predictions.parquet' AS predictions_path, home || '/artifacts' AS artifacts_dir, home || '/result.json' AS result_path,
  home || '/error.json' AS error_path FROM h"""
ORACLE["request_results"] = f"""WITH {PREDICTED}, {STATUS}
SELECT o.request_id, 'done' AS status, coalesce(given, '/requests/' || o.request_id || '/manifest_silver.parquet') AS input_manifest_path,
  '/requests/' || o.request_id || '/predictions.parquet' AS predictions_path, '/requests/' || o.request_id || '/artifacts' AS artifacts_dir,
  CASE WHEN p.vec_id IS NULL THEN 0 ELSE 1 END::BIGINT AS rows, image_id, classifier_pred_idx, round(max_error, 6) AS anomaly_max_error
FROM opened o LEFT JOIN pred p ON o.request_id = 'r' || p.vec_id"""
ORACLE["open_requests"] = f"""WITH {STATUS}
SELECT CASE WHEN status IN ('pending', 'queued') THEN 'pending' WHEN status IN ('done', 'failed') THEN 'terminal' ELSE 'processing' END AS state_group,
  count(*) AS requests FROM last GROUP BY ALL"""
ORACLE["served_requests"] = f"""WITH {MODEL}, {STATUS},
asked AS (SELECT request_id, substr(request_id, 2)::INT % 11 AS label, CASE coalesce(threshold_mode, 'strict')
  WHEN 'custom' THEN custom_threshold WHEN 'p99' THEN p99 WHEN 'p95' THEN p95 ELSE strict END AS t FROM merged CROSS JOIN thr),
hits AS (SELECT request_id, vec_id, any_value(t) AS t, count(*) FILTER (e > t) AS n FROM asked JOIN err USING (label) GROUP BY ALL),
sums AS (SELECT request_id, count(*) AS rows, round(max(t), 6) AS anomaly_threshold, sum(n)::BIGINT AS anomalous_pixels,
  count(*) FILTER (n > 0) AS flagged, sum(k)::BIGINT AS class_sum FROM hits JOIN ranked USING (vec_id) WHERE rk = 1 GROUP BY request_id)
SELECT request_id, CASE WHEN label = 10 THEN 'failed' ELSE 'done' END AS status, rows, anomaly_threshold, anomalous_pixels, flagged, class_sum
FROM asked LEFT JOIN sums USING (request_id)"""
ORACLE["status_machine"] = ORACLE["status_merge"]


def trained(epochs: int, rate: float, penalty: float, classes: int) -> str:
    """Full-batch steps from zero, an epoch each: w0, w1, … and the probabilities p1, p2, … under them; b is the weight of a constant 1."""
    steps = ["ones AS (SELECT vec_id, label, split, i, p FROM px UNION ALL SELECT vec_id, label, split, 64, 1.0 FROM img)",
             f"w0 AS (SELECT k, i, 0.0::DOUBLE AS w FROM range({classes}) a(k), range(65) b(i))"]
    for t in range(epochs + 1):
        steps.append(f"s{t} AS (SELECT vec_id, label, split, k, exp(sum(w * p)) AS s FROM ones JOIN w{t} USING (i) GROUP BY ALL)")
        steps.append(f"p{t} AS (SELECT vec_id, label, split, k, s / sum(s) OVER (PARTITION BY vec_id) AS pr FROM s{t})")
        if t < epochs:
            pull = f"{penalty} * CASE WHEN i < 64 THEN w ELSE 0 END"
            steps.append(f"g{t} AS (SELECT k, i, sum((pr - (label = k)::INT) * p) / count(*) AS g FROM p{t} JOIN ones USING (vec_id, label, split) WHERE split = 'train' GROUP BY ALL)")
            steps.append(f"w{t + 1} AS (SELECT k, i, w - {rate} * (g + {pull}) AS w FROM w{t} JOIN g{t} USING (k, i))")
    every = " UNION ALL ".join(f"SELECT {t} AS epoch, * FROM p{t}" for t in range(1, epochs + 1))
    steps.append(f"seen AS ({every})")
    steps.append("told AS (SELECT epoch, vec_id, split, arg_max(k, pr)::INT AS pred_idx, max(pr) AS confidence, any_value(label) AS label, -ln(greatest(max(pr) FILTER (k = label), 1e-7)) AS loss FROM seen GROUP BY epoch, vec_id, split)")
    steps.append("""history AS (SELECT epoch, avg((pred_idx = label)::INT) FILTER (split = 'train') AS accuracy, avg(loss) FILTER (split = 'train') AS loss,
  avg((pred_idx = label)::INT) FILTER (split = 'val') AS val_accuracy, avg(loss) FILTER (split = 'val') AS val_loss FROM told GROUP BY epoch)""")
    return ",\n".join(steps)


TRAINED = trained(4, 0.5, 0.01, 10)
ORACLE["training_history"] = f"""WITH {MODEL}, {TRAINED}
SELECT epoch, 0.01::DOUBLE AS penalty, round(accuracy, 6) AS accuracy, round(loss, 6) AS loss, round(val_accuracy, 6) AS val_accuracy,
  round(val_loss, 6) AS val_loss FROM history"""
ORACLE["trained_classifier"] = f"""WITH {MODEL}, {TRAINED},
best AS (SELECT epoch FROM history ORDER BY coalesce(val_accuracy, accuracy) DESC, epoch LIMIT 1)
SELECT vec_id, pred_idx, round(confidence, 6) AS classifier_confidence FROM told WHERE epoch = (SELECT epoch FROM best)"""
ORACLE["full_reconstructor"] = "SELECT vec_id, 0::DOUBLE AS max_error, 0::DOUBLE AS mean_error FROM embeddings"
ORACLE["preview_membership"] = f"WITH {ENRICHED} SELECT least(count(*), 10) AS shown, least(count(*), 10) AS known FROM kept"
ORACLE["manifest_reconciled"] = """SELECT sha256('file:/raw/_NORMAL/' || vec_id || '.png') AS image_id, label::INT AS label_idx,
  CASE WHEN vec_id % 7 <> 0 THEN 64 END::INT AS size, CASE WHEN vec_id % 7 = 0 THEN 'missing image' END AS error
FROM embeddings WHERE vec_id % 5 <> 0"""

# Queries whose result SQL does not fix: a preview by any rows, and models fitted iteratively.
WITHOUT_SQL = ("manifest_preview", "fitted_classifier", "fitted_reconstructor")
