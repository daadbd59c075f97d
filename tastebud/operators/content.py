"""Content-based recommender: user profile = mean item vector, cosine top-K.

Candidates are the whole catalogue (every item with a vector); the user's
training items are excluded; users without any catalogue item get no recs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastebud.operators.topk import _by_index, _whole, profile_top_k, top_k_scores
from tastebud.operators.vectors import mean_vectors
from tastebud.session import materialize
from tastebud.sources.io import require_columns


def content_recommend(train: DataFrame, item_vecs: DataFrame, k: int, user_col: str = "user_id",
                      item_col: str = "item_id", vec_col: str = "vec", materialize_items: bool = False,
                      **topk_kw) -> DataFrame:
    """``(user_id, item_id, score, rank)``: top-``k`` unseen catalogue items per user.

    Repeated training rows weigh the profile mean.  ``materialize_items`` writes
    derived item vectors (an encoder's output) once, as they are read more than once.
    """
    require_columns(train, [user_col, item_col], "train")
    require_columns(item_vecs, [item_col, vec_col], "item vectors")
    if materialize_items:
        item_vecs = materialize(item_vecs.select(item_col, vec_col))
    train, item_vecs = train.select(user_col, item_col), item_vecs.select(item_col, vec_col)
    if not _whole(train, user_col) or not _whole(item_vecs, item_col):
        u_index, (t,) = _by_index([train], user_col, "_uidx")
        i_index, (v, t) = _by_index([item_vecs, t], item_col, "_iidx")
        top = content_recommend(t, v, k, user_col, item_col, vec_col, **topk_kw)
        return (top.withColumnRenamed(user_col, "_uidx").withColumnRenamed(item_col, "_iidx")
                .join(u_index, "_uidx").join(i_index, "_iidx").select(user_col, item_col, "score", "rank"))
    pairs = train.join(item_vecs.select(item_col), item_col, "left_semi")
    if "n_item_blocks" not in topk_kw:
        sizes = {c: topk_kw[c] for c in ("chunk_rows", "item_block_bytes") if c in topk_kw}
        top = profile_top_k(pairs, item_vecs, k, user_col, item_col, vec_col, **sizes)
        if top is not None:
            return top
    # Beyond one item block: profiles by a partial aggregation, then blocks of users and items.
    joined = train.join(item_vecs, item_col)
    profiles = materialize(mean_vectors(joined, user_col, vec_col, vec_col))
    return top_k_scores(profiles, item_vecs, k, seen=pairs, metric="cosine",
                        user_col=user_col, item_col=item_col, vec_col=vec_col,
                        **{c: v for c, v in topk_kw.items() if c != "chunk_rows"})


def with_model(recs: DataFrame, name: str) -> DataFrame:
    return recs.withColumn("model", F.lit(name))
