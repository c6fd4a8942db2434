"""Similarity of products and customers, and recommendations."""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.ml.recommendation import ALS
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.functions import blocks
from basketry.functions.columns import rounded, unmark
from basketry.operators.similarity import prefix_pairs, profile_vectors, profiles, shared_pairs
from basketry.session import materialise, ship


def customer_product_matrix(sales: DataFrame) -> DataFrame:
    """Sparse matrix: quantity bought and orders per customer and product."""
    per_order = sales.groupBy("CustomerKey", "ProductKey", "SaleID").agg(F.sum("Quantity").alias("q"))
    grouped = per_order.groupBy("CustomerKey", "ProductKey")
    return grouped.agg(F.sum("q").alias("quantity"), F.count("*").alias("orders"))


def _triples(matrix: DataFrame, entity: str, feature: str) -> DataFrame:
    return matrix.select(F.col(entity).alias("entity"), F.col(feature).alias("feature"), F.col("orders").alias("weight"))


def item_cosine(matrix: DataFrame, min_cosine: float = 0.1, limit: int = 200) -> DataFrame:
    """Products bought by the same customers."""
    triples = materialise(_triples(matrix, "ProductKey", "CustomerKey"), "triples")
    pairs = shared_pairs(triples, min_cosine=min_cosine, limit=limit)
    return pairs.select(F.col("a").alias("item_a"), F.col("b").alias("item_b"), "cosine")


def customer_cosine(matrix: DataFrame, min_cosine: float = 0.5) -> DataFrame:
    """Customers who buy the same products, with equal customers shown once.

    The result grows with the number of like pairs, so the threshold is a high one; pairs below it are not
    formed (``prefix_pairs``). Both columns name profiles (the least customer of a group with equal purchases)
    with their number of members. A profile of several customers is also paired with itself, at 1."""
    triples = materialise(_triples(matrix, "CustomerKey", "ProductKey"), "triples")
    members = materialise(profiles(triples), "profiles")
    pairs = prefix_pairs(profile_vectors(triples, members), min_cosine)
    sizes = members.filter("entity = profile").select("profile", "members")
    named = pairs.join(sizes.toDF("a", "members_a"), "a").join(sizes.toDF("b", "members_b"), "b")
    itself = sizes.filter("members > 1").select(
        F.col("profile").alias("a"),
        F.col("profile").alias("b"),
        F.lit(1.0).alias("cosine"),
        F.col("members").alias("members_a"),
        F.col("members").alias("members_b"),
    )
    both = named.select(itself.columns).unionByName(itself)
    return both.withColumnsRenamed({"a": "profile_a", "b": "profile_b"})


def _top(df: DataFrame, within: str, order: list, n: int) -> DataFrame:
    """First ``n`` rows per group. Spark cuts each task's share to ``n`` before the shuffle."""
    place = F.row_number().over(Window.partitionBy(within).orderBy(*order))
    return df.withColumn("rank", place).filter(F.col("rank") <= n)


#: A customer with more products than this is not multiplied out with itself.
_LARGE = 1000
#: What one task holds, about: sums of the product matrix and entries of customers' vectors; customers and products of a
#: factorisation.
_MATRIX, _ENTRIES, _CUSTOMERS, _PRODUCTS = 1 << 23, 1 << 21, 1 << 18, 1 << 18
#: Ratings in a block of a factorisation, about.
_RATINGS = 1 << 21


def _each(count: int) -> Column:
    return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))


def _dealt(c: str, count: int) -> Column:
    return F.pmod(F.xxhash64(c), F.lit(count)).cast("int")


def recommend_top_n(matrix: DataFrame, n: int = 5) -> DataFrame:
    """Products a customer has not bought, by the similarity of all customers who did.

    The score of a product is the sum over all customers of cosine times orders. Written with unit vectors it
    is a product of the customer's own vector and a product-by-product matrix, summed over customers once: no
    two customers are ever paired. Customers with equal purchases get the same products, so the work is done
    per profile; a profile counts with its members. What the customer's own purchases add concerns only
    products bought already.

    A task has some columns of the matrix, which it sums from the vectors of those who bought these products, and some
    customers, and hands on the best of each; neither matrix nor scores are laid out in rows. A customer of very many
    products would fill the matrix alone: its cosine is one feature more of the others, its orders one row more."""
    ship(matrix.sparkSession)
    triples = materialise(_triples(matrix, "CustomerKey", "ProductKey"), "triples")
    members = materialise(profiles(triples), "profiles")
    vectors = materialise(profile_vectors(triples, members), "triples")
    norms = vectors.groupBy("entity").agg(F.sqrt(F.sum(F.col("weight") * F.col("weight")).cast("double")).alias("norm"), (F.count("*") > _LARGE).alias("large"))
    sizes = members.filter("entity = profile").select("entity", "members")
    units = vectors.filter("feature IS NOT NULL").join(norms, "entity").join(sizes, "entity").select(
        F.col("entity").cast("long").alias("entity"),
        (F.col("feature").cast("long") * 2).alias("code"),  # products are even, large customers odd
        (F.col("weight") / F.col("norm")).alias("unit"),
        (F.col("weight") * F.col("members")).cast("double").alias("orders"),
        "large",
    )
    units = materialise(units, "units")
    other = units.filter("large").select((F.col("entity") * 2 + 1).alias("other"), "code", F.col("unit").alias("theirs"))
    cosines = units.join(other, "code").groupBy("entity", F.col("other")).agg(F.sum(F.col("unit") * F.col("theirs")).alias("unit"))
    features = units.select("entity", "code", "unit").unionByName(cosines.withColumnRenamed("other", "code"))
    people = materialise(features.groupBy("entity").agg(F.collect_list(F.struct("code", "unit")).alias("v")), "people")

    k = F.count("*").cast("double")
    counted = units.groupBy("entity", "large").agg(k.alias("k")).agg(F.sum(F.when(F.col("large"), F.col("k")).otherwise(F.col("k") * F.col("k"))), F.sum("k"))
    formed, held = (x or 0 for x in counted.first())
    rows = max(1, math.ceil(held / _ENTRIES))
    columns = max(1, math.ceil(formed / _MATRIX), math.ceil(2 * matrix.sparkSession.sparkContext.defaultParallelism / rows))
    left = people.select(_dealt("entity", rows).alias("row"), _each(columns).alias("column"), "entity", F.col("v.code").alias("codes"), F.col("v.unit").alias("units"))
    parts = units.groupBy("entity", "large", _dealt("code", columns).alias("column")).agg(F.collect_list(F.struct("code", "orders")).alias("p"))
    itself = F.array(F.struct((F.col("entity") * 2 + 1).alias("code"), F.lit(1.0).alias("unit")))
    own = F.when(F.col("large"), itself).otherwise(F.filter("v", lambda x: x["code"] % 2 == 0))
    right = parts.join(people, "entity").withColumn("v", own).select(
        _each(rows).alias("row"), "column", F.col("v.code").alias("codes"), F.col("v.unit").alias("units"), F.col("p.code").alias("products"), F.col("p.orders").alias("orders")
    )

    def best(people: pa.Table, buyers: pa.Table) -> pa.Table:
        lengths, codes = blocks.flat(buyers["codes"])
        counts, products = blocks.flat(buyers["products"])
        summed = blocks.outer_sums((lengths, codes, blocks.flat(buyers["units"])[1]), (counts, products, blocks.flat(buyers["orders"])[1]))
        lengths, codes = blocks.flat(people["codes"])
        at, code, score = blocks.best_of_sparse((lengths, codes, blocks.flat(people["units"])[1]), summed, n, 1e-4)
        return pa.table({"a": people["entity"].to_numpy()[at], "ProductKey": code // 2, "score": score})

    found = left.groupBy("row", "column").cogroup(right.groupBy("row", "column")).applyInArrow(best, "a long, ProductKey long, score double")
    kinds = {c: matrix.schema[c].dataType for c in ("CustomerKey", "ProductKey")}
    scored = found.select("a", F.col("ProductKey").cast(kinds["ProductKey"]).alias("ProductKey"), rounded("score", 4).alias("score"))
    best_of_all = _top(scored, "a", [F.desc("score"), "ProductKey"], n)
    everyone = members.select(F.col("entity").alias("CustomerKey"), F.col("profile").cast("long").alias("a"))
    return everyone.join(best_of_all, "a").select("CustomerKey", "ProductKey", "score", "rank")


def als_recommend(matrix: DataFrame, n: int = 5, rank: int = 8, iterations: int = 5, seed: int = 42) -> DataFrame:
    """Collaborative filtering by factorisation of the matrix (implicit feedback).

    A task holds a block of ratings and the factors of all whom it names, so blocks grow in number with the ratings; up to
    ten times ``_RATINGS`` there are the ten that Spark makes. First factors are drawn by block."""
    ratings = materialise(matrix.select("CustomerKey", "ProductKey", F.col("orders").cast("float").alias("orders")), "ratings")
    als = ALS(
        userCol="CustomerKey",
        itemCol="ProductKey",
        ratingCol="orders",
        implicitPrefs=True,
        rank=rank,
        maxIter=iterations,
        seed=seed,
        coldStartStrategy="drop",
    )
    model = als.setNumBlocks(max(als.getNumUserBlocks(), math.ceil(ratings.count() / _RATINGS))).fit(ratings)
    lists = best_products(model.userFactors, model.itemFactors, n)
    return lists.select(F.col("id").alias("CustomerKey"), F.col("product").alias("ProductKey"), "score", "rank")


def best_products(customers: DataFrame, products: DataFrame, n: int) -> DataFrame:
    """The ``n`` products with the greatest product of factors for each customer: id, product, score, rank.

    Some customers meet some products in a task, which computes only those that can be among the best
    (``blocks.best_of_dense``); no pair of a customer and a product that is not becomes a row."""
    ship(customers.sparkSession)
    rows, columns = (max(1, math.ceil(df.count() / most)) for df, most in ((customers, _CUSTOMERS), (products, _PRODUCTS)))
    rows = max(rows, math.ceil(2 * customers.sparkSession.sparkContext.defaultParallelism / columns))
    left = customers.select(_dealt("id", rows).alias("row"), _each(columns).alias("column"), "id", "features")
    right = products.select(_each(rows).alias("row"), _dealt("id", columns).alias("column"), "id", "features")

    def best(people: pa.Table, goods: pa.Table) -> pa.Table:
        if not len(people) or not len(goods):
            return pa.table({"id": pa.array([], pa.int32()), "product": pa.array([], pa.int32()), "score": pa.array([], pa.float64())})
        x, y = (blocks.flat(t["features"])[1].reshape(len(t), -1) for t in (people, goods))
        at, product, score = blocks.best_of_dense(x, y, goods["id"].to_numpy().astype("int64"), n)
        return pa.table({"id": people["id"].to_numpy()[at], "product": product.astype("int32"), "score": score})

    found = left.groupBy("row", "column").cogroup(right.groupBy("row", "column")).applyInArrow(best, "id int, product int, score double")
    return _top(found, "id", [F.desc("score"), "product"], n)


def product_tokens(products: DataFrame) -> DataFrame:
    """Distinct lower-case words of brand, name and alias per product, tagged with their column."""
    words = []
    for column in ("Brand", "ProductName", "NameAlias"):
        text = F.lower(F.coalesce(unmark(column), F.lit("")))
        parts = F.filter(F.split(text, r"\s+"), lambda w: w != "")
        words.append(F.transform(parts, lambda w, column=column: F.concat(F.lit(f"{column}:"), w)))
    return products.select("ProductKey", F.explode(F.array_distinct(F.concat(*words))).alias("token"))


def content_similar(products: DataFrame, min_cosine: float = 0.8, limit: int = 200) -> DataFrame:
    """Products with similar attributes: cosine of inverse-document-frequency weights of their words.

    Products with the same words form one profile, named after the least of them."""
    tokens = product_tokens(products)
    n = tokens.agg(F.count_distinct("ProductKey")).scalar().cast("double")
    frequency = tokens.groupBy("token").agg(F.count("*").alias("df"))
    weight = F.ln((n + 1.0) / (F.col("df").cast("double") + 1.0))
    weights = frequency.select("token", weight.alias("weight")).filter("weight > 0")
    weighted = tokens.join(weights, "token").select(
        F.col("ProductKey").alias("entity"), F.col("token").alias("feature"), "weight"
    )
    triples = materialise(weighted, "triples")
    members = materialise(profiles(triples), "profiles")
    vectors = materialise(profile_vectors(triples, members), "triples")
    pairs = shared_pairs(vectors, min_cosine=min_cosine, limit=limit)
    sizes = members.filter("entity = profile").select("profile", "members")
    named = pairs.join(sizes.toDF("a", "members_a"), "a").join(sizes.toDF("b", "members_b"), "b")
    return named.select(F.col("a").alias("profile_a"), F.col("b").alias("profile_b"), "members_a", "members_b", "cosine")


def recommend_by_segment(matrix: DataFrame, rfm: DataFrame, n: int = 5) -> DataFrame:
    """Products by the number of customers of the segment that buy them."""
    joined = matrix.join(rfm.select("CustomerKey", "Segment"), "CustomerKey")
    counted = joined.groupBy("Segment", "ProductKey").agg(
        F.count("*").alias("customers"), F.sum("quantity").alias("quantity")
    )
    return _top(counted, "Segment", [F.desc("customers"), F.desc("quantity"), "ProductKey"], n)
