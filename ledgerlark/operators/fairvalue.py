"""Oil-price fair values of listed producers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Ticker, currency, rule, anchor oil price, anchor share price, sensitivity, beta, last price, correlation, r2.
MODELS = [
    ("SQZ.L", "GBP", "fixed", 85.0, 2.3485, 0.01782802229169472, 0.6604718190263774, 2.478, 0.72, 0.52),
    ("ITH.L", "GBP", "fixed", 76.03, 2.222, 0.019513586822459475, 0.667694872237441, 2.434, 0.72, 0.52),
    ("HBR.L", "GBP", "fixed", 76.03, 2.172, 0.018593958695330988, 0.6508741618812223, 2.46, 0.75, 0.57),
    ("ENQ.L", "GBP", "fixed", 76.03, 0.221, 0.0019921810482344308, 0.6853643669559446, 0.246, 0.42, 0.18),
    ("VAR.OL", "NOK", "beta_anchor", None, None, None, 0.38, None, None, None),
    ("AKRBP.OL", "NOK", "beta_anchor", None, None, None, 0.4, None, 0.88, None),
    ("PEN.OL", "NOK", "beta_anchor", None, None, None, 0.26, None, 0.49, None),
    ("JSE.L", "GBP", "fixed", 76.03, 0.285, 0.0007857173920733937, 0.2096073449801408, 0.305, 0.29, 0.09),
    ("PXT.TO", "CAD", "manual_multi", None, None, None, None, None, None, None),
    ("IPCO.ST", "SEK", "manual_multi", None, None, None, None, None, None, None),
    ("AET.L", "GBP", "fixed", 76.03, 0.601, 0.004955141879774274, 0.626854304690912, 0.71, 0.57, 0.33),
    ("PTAL.L", "GBP", "fixed", 76.03, 0.255, 0.0012207005392883329, 0.3639602431454586, 0.255, 0.42, 0.18),
]
MODEL_SCHEMA = "ticker string, currency string, rule string, anchor_oil double, anchor_price double, sensitivity double, beta double, price double, corr double, r2 double"
# Default oil price and presets.
DEFAULT_OIL, PRESETS = 88.52, (85.0, 90.0, 95.0)


def fair_value(oil: Column, rule: Column, anchor_oil: Column, anchor_price: Column, sensitivity: Column, beta: Column) -> Column:
    """Anchor price plus sensitivity times the oil price's distance; sensitivity from a positive beta where the rule says so."""
    s = F.when(rule == "fixed", sensitivity).otherwise(F.when(beta > 0, beta * anchor_price / anchor_oil))
    return anchor_price + s * (oil - anchor_oil)


def levels(df: DataFrame, fair: str, price: str, own_news: str) -> DataFrame:
    """Entry levels 1 to 3 percent below fair value with target and stop; the gap is suspended on own news."""
    n = F.explode(F.array(*[F.lit(i) for i in (1, 2, 3)]))
    entry = F.col(fair) / (1 + F.col("level") / 100)
    out = df.withColumn("level", n).withColumn("entry", entry)
    gap = F.when((F.col(price) > 0) & ~F.col(own_news), (F.col(fair) / F.col(price) - 1) * 100)
    return out.withColumns({"target": F.col("entry") * (1 + F.col("level") / 100), "stop": F.col("entry") * 0.97, "gap_pct": gap})
