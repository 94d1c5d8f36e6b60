"""Embedding near-duplicates: int8 tile products with error bounds, doubles only where they can matter."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigilo.llm.common import components, forest, table
from vigilo.llm.vectors import matrix, rows_with_vectors
from vigilo.sources.tables import stage

#: Vectors in a block; a tile multiplies two blocks.
BLOCK = 1024
_SIGNS = 16
_BLOCK_FIELDS = "grp string, block long, n int, dim int, ids binary, copies binary, codes binary, scale binary, err binary, full binary, centre array<double>, radius double"


def quantise(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Int8 codes of unit vectors, their scale, and the exact length of what the codes leave out."""
    scale = np.abs(unit).max(1) / 127.0
    codes = np.rint(unit / scale[:, None]).astype(np.int8)
    return codes, scale, np.linalg.norm(unit - codes * scale[:, None], axis=1)


def _sign_codes(batches):
    """The signs against fixed directions: vectors close to each other tend to share leading bits."""
    import pyarrow as pa

    for batch in batches:
        vec, out = batch.column(1), np.zeros(batch.num_rows, dtype=np.int64)
        sizes = np.diff(np.asarray(vec.offsets))
        flat = np.asarray(vec.flatten(), dtype=np.float64)
        starts = np.concatenate([[0], np.cumsum(sizes)])
        for size in np.unique(sizes):
            rows = np.flatnonzero(sizes == size)
            dirs = np.random.default_rng(size).standard_normal((size, _SIGNS))
            x = flat[starts[rows][:, None] + np.arange(size)]
            out[rows] = ((x / np.abs(x).max(1)[:, None]) @ dirs > 0) @ (1 << np.arange(_SIGNS)[::-1])
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out)], names=[*batch.schema.names, "code"])


def _pack(part):
    """One row for a block: ids, copies, codes with scales and errors, full vectors, centre and radius."""
    import pyarrow as pa

    part = part.combine_chunks()
    x = matrix(part.column("vec").chunk(0))
    # Dividing by the largest component first keeps the length of huge and tiny vectors exact.
    y = x / np.abs(x).max(1)[:, None]
    unit = y / np.linalg.norm(y, axis=1)[:, None]
    codes, scale, err = quantise(unit)
    mean = unit.mean(0)
    size = np.linalg.norm(mean)
    centre = mean / size if size > 1e-9 else unit[0]
    radius = float(np.arccos(np.clip(unit @ centre, -1, 1)).max())
    pack = lambda a: pa.array([a.tobytes()], pa.binary())
    return pa.table({
        "grp": part.column("grp").slice(0, 1), "block": part.column("block").slice(0, 1),
        "n": pa.array([len(x)], pa.int32()), "dim": pa.array([x.shape[1]], pa.int32()),
        "ids": pack(np.asarray(part.column("id"), dtype=np.int64)), "copies": pack(np.asarray(part.column("copies"), dtype=np.int64)),
        "codes": pack(codes), "scale": pack(scale), "err": pack(err), "full": pack(unit),
        "centre": pa.array([centre.tolist()], pa.list_(pa.float64())), "radius": pa.array([radius])})


def _links(a: dict, b: dict, threshold: float) -> np.ndarray:
    """Which pairs of two blocks reach the threshold, as a matrix.

    With x = s·q + e, the dot product of two unit vectors differs from that of the scaled codes by no more
    than |e| + |e'| + |e||e'|. The products of codes are whole numbers below 2^24 for up to 1,040
    dimensions and are added in chunks beyond, so float32 holds them exactly.
    """
    near = np.zeros((a["n"], b["n"]))
    for at in range(0, a["dim"], 1024):
        near += a["codes"][:, at:at + 1024].astype(np.float32) @ b["codes"][:, at:at + 1024].astype(np.float32).T
    near *= a["scale"][:, None]
    near *= b["scale"]
    slack = a["err"][:, None] + b["err"] + a["err"][:, None] * b["err"] + 1e-9
    possible = near >= threshold - slack
    i, j = np.nonzero(possible)
    for at in range(0, len(i), 1 << 15):
        p, q = i[at:at + (1 << 15)], j[at:at + (1 << 15)]
        possible[p, q] = np.einsum("nd,nd->n", a["full"][p], b["full"][q]) >= threshold
    return possible


def _unpack(row: dict) -> dict:
    n, dim = row["n"], row["dim"]
    shape = {"codes": (np.int8, (n, dim)), "full": (np.float64, (n, dim)), "ids": (np.int64, n), "copies": (np.int64, n),
             "scale": (np.float64, n), "err": (np.float64, n)}
    return {"n": n, "dim": dim} | {k: np.frombuffer(row[k], kind).reshape(size) for k, (kind, size) in shape.items()}


def near_duplicates(vectors: DataFrame, key: str, vector: str, label: str, threshold: float = 0.93) -> DataFrame:
    """Per row its ``vec_id``, ``n_links``, ``component_id`` and ``kept``.

    Rows with equal labels are linked when the cosine of their vectors in double precision reaches the
    threshold. Equal vectors are one point with its number of copies; points of a label are dealt to blocks
    of about ``BLOCK`` along the signs of fixed projections, a larger cell being cut into several. Two blocks
    meet only if the angle of their centres less both radii leaves room for a link, so no link is lost. A
    tile multiplies int8 codes, recomputes the pairs its error bounds cannot rule out, counts the links of
    each point and gives back only a spanning forest.

    Nulls: a vector that is null, empty, zero or holds null or non-finite components, and a null label, link
    with nothing; a row with a null key is returned alone with a null component and ``kept`` false. Vectors
    of different length never link. Repeated rows count as rows and link with each other.
    """
    rows = rows_with_vectors(vectors, key, vector, F.col(label).cast("string").alias("label"))
    linkable = (F.col("vec").isNotNull() & F.col("label").isNotNull() & F.col("id").isNotNull())
    rows = rows.withColumn("grp", F.when(linkable, F.concat_ws(":", F.size("vec"), "label")))
    points = stage(rows.where("grp is not null").groupBy("vec", "grp").agg(F.min("id").alias("id"), F.count("*").alias("copies"))
                   .select("grp", "vec", "id", "copies").mapInArrow(_sign_codes, "grp string, vec array<double>, id long, copies long, code long"), "points")
    bits = F.greatest(F.lit(0), F.ceil(F.log2(F.col("n") / BLOCK)))
    sizes = points.groupBy("grp").agg(F.count("*").alias("n")).select("grp", F.least(bits, F.lit(_SIGNS)).cast("int").alias("bits"))
    celled = points.join(sizes, "grp").withColumn("cell", F.call_function("shiftright", F.col("code"), F.lit(_SIGNS) - F.col("bits")))
    cuts = celled.groupBy("grp", "cell").agg(F.ceil(F.count("*") / BLOCK).alias("cuts"))
    dealt = celled.join(cuts, ["grp", "cell"]).withColumn(
        "block", F.col("cell") * F.lit(1 << 40) + F.pmod(F.xxhash64("id"), F.col("cuts")))
    blocks = stage(dealt.select("grp", "block", "id", "copies", "vec").groupBy("grp", "block").applyInArrow(_pack, _BLOCK_FIELDS), "blocks")

    short = blocks.select("grp", "block", "centre", "radius")
    right = short.select("grp", F.col("block").alias("block2"), F.col("centre").alias("centre2"), F.col("radius").alias("radius2"))
    dot = F.aggregate(F.zip_with("centre", "centre2", lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    angle = F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), dot))) - F.col("radius") - F.col("radius2")
    # One row for each pair of blocks, not of vectors: what the bound of the whole block leaves.
    tiles = short.join(right, "grp").where("block <= block2").where(angle <= float(np.arccos(threshold)) + 1e-6)
    tiles = tiles.select("grp", "block", "block2", F.xxhash64("grp", "block", "block2").alias("tile"))
    sides = tiles.select("grp", "tile", F.explode(F.array_distinct(F.array("block", "block2"))).alias("block"))

    def multiply(_, part):
        import pyarrow as pa

        row = part.to_pylist()
        a, b = _unpack(row[0]), _unpack(row[-1])
        linked = _links(a, b, threshold)
        if len(row) == 1:
            np.fill_diagonal(linked, False)
            counts = [(a["ids"], linked @ a["copies"])]
        else:
            counts = [(a["ids"], linked @ b["copies"]), (b["ids"], a["copies"] @ linked)]
        ids = np.concatenate([c[0] for c in counts])
        n = np.concatenate([c[1] for c in counts])
        i, j = np.nonzero(linked)
        node, low = forest(a["ids"][i], b["ids"][j]) if len(i) else (ids[:0], ids[:0])
        seen = n > 0
        none = np.zeros(len(node), dtype=np.int64)
        return pa.table({"node": np.concatenate([ids[seen], node]), "n": np.concatenate([n[seen], none]),
                         "low": pa.concat_arrays([pa.nulls(int(seen.sum()), pa.int64()), pa.array(low, pa.int64())])})

    found = stage(sides.join(blocks, ["grp", "block"]).groupBy("tile").applyInArrow(multiply, "node long, n long, low long"), "links")
    counts = found.groupBy("node").agg(F.sum("n").alias("n"))
    reach = components(found.where("low is not null and low != node"), "node", "low")
    known = (points.select("grp", "vec", "copies", F.col("id").alias("node"))
             .join(counts, "node", "left").join(reach, "node", "left")
             .select("grp", "vec", (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n"),
                     F.coalesce("component", "node").alias("component")))
    done = rows.join(known, ["grp", "vec"], "left")
    part = F.coalesce("component", "id")
    return done.select(F.col("id").alias("vec_id"), F.coalesce("n", F.lit(0).cast("long")).alias("n_links"),
                       part.alias("component_id"), F.coalesce(part == F.col("id"), F.lit(False)).alias("kept"))


def op1_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "embeddings"), "vec_id", "embedding", "label")


OP1_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
      WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
r(a, c) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT l.b, r.c FROM r JOIN l ON l.a = r.a WHERE r.c < l.b),
m AS (SELECT a, min(c) AS c FROM r GROUP BY a),
n AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT e.vec_id, coalesce(n.n, 0) AS n_links, m.c AS component_id, e.vec_id = m.c AS kept
FROM embeddings e JOIN m ON m.a = e.vec_id LEFT JOIN n ON n.a = e.vec_id
"""
