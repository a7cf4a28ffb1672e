"""K-means, choice of k, silhouettes, principal components."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.operators import lloyd
from tallyloom.operators.scaling import fit_standard
from tallyloom.session import stage



def assemble(df: DataFrame, columns: Sequence[str], output: str = "features") -> DataFrame:
    """The listed columns as one vector column."""
    return VectorAssembler(inputCols=list(columns), outputCol=output, handleInvalid="error").transform(df)


def standardised(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Columns centred and divided by their population deviation."""
    return fit_standard(df, columns).transform(df)


def fit_kmeans(
    df: DataFrame, columns: Sequence[str], k: int, max_iter: int = 1000, seed: int = 0, name: str = "cluster"
) -> PipelineModel:
    """A pipeline from columns to a cluster number."""
    steps = [
        VectorAssembler(inputCols=list(columns), outputCol="features", handleInvalid="error"),
        KMeans(k=k, maxIter=max_iter, seed=seed, featuresCol="features", predictionCol=name),
    ]
    return Pipeline(stages=steps).fit(df)


def add_clusters(
    df: DataFrame, columns: Sequence[str], raw_k: int = 3, scaled_k: int = 5, max_iter: int = 1000, seed: int = 0
) -> DataFrame:
    """Add ``cluster_k3_raw`` and ``cluster_k5_scaled`` (named after the two k)."""
    raw, scaled = f"cluster_k{raw_k}_raw", f"cluster_k{scaled_k}_scaled"
    frame = fit_kmeans(df, columns, raw_k, max_iter, seed, raw).transform(df).drop("features")
    scaling = fit_standard(df, columns)
    model = fit_kmeans(scaling.transform(df), columns, scaled_k, max_iter, seed, scaled)
    originals = {f"_{c}": F.col(c) for c in columns}
    frame = model.transform(scaling.transform(frame.withColumns(originals))).drop("features", *columns)
    return frame.withColumnsRenamed({f"_{c}": c for c in columns}).select(*df.columns, raw, scaled)


def choose_k(
    df: DataFrame, columns: Sequence[str], ks: Sequence[int], max_iter: int = 1000, seed: int = 0,
    silhouettes: bool = True,
) -> DataFrame:
    """Rows (k, wcss, silhouette) for each k; each pass over the staged features serves all k.

    Silhouettes are on squared Euclidean distances, whose cluster sums have a closed
    form, so that the work is linear in the rows. The silhouette is null for k = 1, and where
    the rows have a single distinct value.
    """
    points = lloyd.points_of(df, columns)
    middle, centres, sums, _ = lloyd.fit_all(points, ks, max_iter, seed)
    costs = sums.groupby("k")["cost"].sum().to_dict()
    scores = lloyd.silhouettes(points, middle, centres, sums) if silhouettes else {}
    rows = [(int(k), float(costs.get(k, 0.0)), scores.get(int(k))) for k in ks]
    return df.sparkSession.createDataFrame(rows, "k int, wcss double, silhouette double")


def silhouette_rows(df: DataFrame, row_id: str, columns: Sequence[str], cluster: str) -> DataFrame:
    """Silhouette of every row: (row_id, cluster, silhouette), on squared Euclidean distances.

    The mean squared distance from x to a cluster of size n with mean m and mean
    square s is |x|^2 - 2 x.m + s, so each row needs only the clusters' means. The
    means are one row per cluster. A row alone in its cluster scores 0.
    """
    x = {c: F.col(c).cast("double") for c in columns}
    # Centre first: distances do not change and the differences of squares lose less.
    centre = df.agg(*[F.avg(c).alias(c) for c in columns]).first()
    x = {c: x[c] - F.lit(centre[c]) for c in columns}
    square = sum((x[c] * x[c] for c in columns), F.lit(0.0))
    stats = stage(
        df.groupBy(F.col(cluster).alias("other")).agg(
            F.count(F.lit(1)).cast("double").alias("size"), F.avg(square).alias("mean_square"),
            F.array(*[F.avg(x[c]) for c in columns]).alias("mean"),
        )
    )
    packed = stats.agg(F.collect_list(F.struct("other", "size", "mean_square", "mean"))).scalar()
    point = F.array(*[x[c] for c in columns])

    def distance(s: Column) -> Column:
        dot = F.aggregate(F.zip_with("_x", s["mean"], lambda a, b: a * b), F.lit(0.0), lambda t, v: t + v)
        return F.greatest(F.col("_xx") - 2 * dot + s["mean_square"], F.lit(0.0))

    rows = df.select(row_id, cluster, point.alias("_x"), square.alias("_xx"), packed.alias("_s")).withColumn(
        "_d",
        F.transform("_s", lambda s: F.struct((s["other"] == F.col(cluster)).alias("own"), s["size"].alias("size"), distance(s).alias("d"))),
    )
    own = F.filter("_d", lambda d: d["own"])[0]
    near = F.array_min(F.transform(F.filter("_d", lambda d: ~d["own"]), lambda d: d["d"]))
    rows = rows.select(
        row_id, cluster, own["size"].alias("size"),
        # The mean over the cluster counts the row itself, at distance 0.
        F.try_divide(own["d"] * own["size"], own["size"] - 1).alias("a"), near.alias("b"),
    )
    score = F.when(F.col("size") <= 1, F.lit(0.0)).otherwise(
        F.coalesce(F.try_divide(F.col("b") - F.col("a"), F.greatest("a", "b")), F.lit(0.0))
    )
    return rows.select(row_id, cluster, score.alias("silhouette"))


def cluster_quality(df: DataFrame, row_id: str, columns: Sequence[str], cluster: str) -> DataFrame:
    """One row: inertia and mean silhouette of a clustering, on the features only."""
    silhouette = silhouette_rows(df, row_id, columns, cluster).agg(F.avg("silhouette")).scalar()
    variances = [F.var_pop(c) * F.count(F.lit(1)) for c in columns]
    per_cluster = df.groupBy(cluster).agg(sum(variances[1:], variances[0]).alias("inertia"))
    return per_cluster.agg(F.sum("inertia").alias("inertia"), silhouette.alias("silhouette"))


def principal_components(df: DataFrame, columns: Sequence[str], k: int = 2, keep: Sequence[str] = ()) -> DataFrame:
    """The first ``k`` principal components of centred columns, as ``pc1``, ``pc2``, ... The signs are arbitrary."""
    means = df.agg(*[F.avg(c).alias(c) for c in columns]).first()
    centred = df.select(*keep, *[(F.col(c) - F.lit(means[c])).alias(f"_{c}") for c in columns])
    vectors = stage(assemble(centred, [f"_{c}" for c in columns]).select(*keep, "features"))
    model = PCA(k=k, inputCol="features", outputCol="components").fit(vectors)
    parts = vector_to_array("components")
    return model.transform(vectors).select(*keep, *[parts[i].alias(f"pc{i + 1}") for i in range(k)])


def cluster_scatter(df: DataFrame, row_id: str, columns: Sequence[str], cluster: str) -> DataFrame:
    """Scatter table (row_id, x, y, cluster) on the first two principal components."""
    frame = principal_components(df, columns, 2, keep=[row_id, cluster])
    return frame.select(row_id, F.col("pc1").alias("x"), F.col("pc2").alias("y"), F.col(cluster).cast("string").alias("cluster"))
