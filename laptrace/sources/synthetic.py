"""Synthetic wide table, for trying a training run without data."""

from __future__ import annotations

import math
from itertools import accumulate

from pyspark.sql import Column, DataFrame, functions as F

from laptrace.functions.lookups import hash_uniform
from laptrace.vocab import SEED

# fixed values: layout of the synthetic table
TIME_COLUMNS = [
    "50mFree_SCY_Age10_FastestTime", "100mFree_SCY_Age12_FastestTime", "200mFree_LCM_Age15_FastestTime",
    "100mBack_SCY_Age14_FastestTime", "200mBack_LCM_Age16_FastestTime", "100mBreast_SCY_Age13_FastestTime",
    "200mBreast_LCM_Age17_FastestTime", "100mFly_SCY_Age15_FastestTime", "200mFly_LCM_Age18_FastestTime",
    "200mIM_SCY_Age16_FastestTime", "400mIM_LCM_Age17_FastestTime",
]
INDICATORS = [
    "Olympic_50m_Freestyle", "Olympic_100m_Freestyle", "Olympic_200m_Freestyle", "Olympic_100m_Backstroke",
    "Olympic_200m_Backstroke", "Olympic_100m_Breaststroke", "Olympic_200m_Breaststroke",
    "Olympic_100m_Butterfly", "Olympic_200m_Butterfly", "Olympic_200m_IM", "Olympic_400m_IM",
    "Olympic_4x100m_Freestyle_Relay", "Olympic_4x200m_Freestyle_Relay",
]
LABEL_SHARES = {
    "50m_Freestyle": 0.08, "100m_Freestyle": 0.12, "200m_Freestyle": 0.10, "100m_Backstroke": 0.08,
    "200m_Backstroke": 0.06, "100m_Breaststroke": 0.08, "200m_Breaststroke": 0.06, "100m_Butterfly": 0.08,
    "200m_Butterfly": 0.06, "200m_IM": 0.08, "400m_IM": 0.05, "No_Olympic_Event": 0.25,
}
FLAG_SHARES = {"White": 0.7, "Black": 0.2, "Asian": 0.1, "Hispanic": 0.15}
BODY = {"Height_cm": (175.0, 10.0), "Weight_kg": (70.0, 15.0), "BMI": (23.0, 3.0)}
TIME_MEAN, TIME_SPREAD, MISSING_SHARE, INDICATOR_SHARE = 60.0, 20.0, 0.3, 0.1


def normal(key: Column, salt: str, mean: float, spread: float) -> Column:
    """Normal draw (Box-Muller) from two hashed uniforms."""
    u = F.greatest(hash_uniform(key, salt + "/u"), F.lit(1e-9))
    v = hash_uniform(key, salt + "/v")
    return F.lit(mean) + F.lit(spread) * F.sqrt(F.lit(-2.0) * F.log(u)) * F.cos(F.lit(2 * math.pi) * v)


def synthetic_wide(keys: DataFrame, key: str, seed: int = SEED) -> DataFrame:
    """One synthetic athlete per key.  Every value is a hash of key, column and seed, so it is the
    same for any partitioning and any number of keys."""
    k = F.col(key)

    def flag(name: str, share: float) -> Column:
        return (hash_uniform(k, f"{seed}/{name}") < share).cast("int")

    columns = {"Name": F.concat(F.lit("Swimmer_"), k.cast("string")), "Sex_encoded": flag("Sex_encoded", 0.5)}
    for name, (mean, spread) in BODY.items():
        columns[name] = normal(k, f"{seed}/{name}", mean, spread)
    for name, share in FLAG_SHARES.items():
        columns[f"Ethnicity_{name}"] = flag(f"Ethnicity_{name}", share)
    for name in TIME_COLUMNS:
        drawn = F.abs(normal(k, f"{seed}/{name}", TIME_MEAN, TIME_SPREAD))
        columns[name] = F.when(hash_uniform(k, f"{seed}/{name}/gap") >= MISSING_SHARE, drawn)
    for name in INDICATORS:
        columns[name] = flag(name, INDICATOR_SHARE)
    draw = hash_uniform(k, f"{seed}/label")
    names = list(LABEL_SHARES)
    edges = [round(e, 6) for e in accumulate(LABEL_SHARES.values())]
    label = F.lit(names[-1])
    for name, edge in reversed(list(zip(names, edges))):
        label = F.when(draw < edge, F.lit(name)).otherwise(label)
    columns["Target_Olympic_Event"] = label
    return keys.select(*[c.alias(n) for n, c in columns.items()])
