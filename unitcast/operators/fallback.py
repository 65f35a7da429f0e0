"""Cold-start fill (H11) built on share indices."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from unitcast import config
from unitcast.functions.columns import clip
from unitcast.operators.aggregate import share_index, with_scalar
from unitcast.operators.clean import fill_from
from unitcast.operators.joins import materialize


def cold_start_fill(request: DataFrame, preds: DataFrame, factor: float = config.COLD_START_FACTOR,
                    pred: str = "pred", out: str = "item_cnt_month", id_col: str = "ID",
                    shop: str = "shop_id", item: str = "item_id", use_item_index: bool = True,
                    clip_range=(config.CLIP_LO, config.CLIP_HI)) -> DataFrame:
    """Request rows get their pair's prediction; a pair without one gets
    ``mean x shop index x item index x factor``, then ``mean x shop index x
    factor``; then the value is clipped.  ``mean`` is the mean prediction over
    the request rows that have one; the indices are each key's prediction sum
    over the mean of those sums (computed over all predicted pairs).  With
    ``use_item_index=False`` the degenerate variant ``mean x factor`` is used.
    The predictions and the request rows that met them are read several times
    (fill, mean, both indices), so both are stored.
    """
    preds = materialize(preds.select(shop, item, pred))
    s = materialize(request.select(id_col, shop, item).join(preds, [shop, item], "left"))
    if use_item_index:
        s = (s.join(share_index(preds, shop, pred, "_shop_idx"), shop, "left")
              .join(share_index(preds, item, pred, "_item_idx"), item, "left"))
    mean = s.agg(F.avg(pred).alias("_v"))
    s = with_scalar(s, mean)
    if use_item_index:
        second = F.col("_v") * F.col("_shop_idx") * F.col("_item_idx") * F.lit(factor)
        third = F.col("_v") * F.col("_shop_idx") * F.lit(factor)
    else:
        second = third = F.col("_v") * F.lit(factor)
    s = fill_from(s.withColumn(out, F.col(pred)), out, second, third)   # B13 cascade
    value = clip(out, *clip_range) if clip_range is not None else F.col(out)
    return s.select(id_col, value.alias(out))
