"""Column builders for style values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


#: Three channels of a colour function, by comma or space, as numbers or percentages.
_CHANNELS = r"rgba?\(\s*([\d.]+)(%?)[,\s]\s*([\d.]+)(%?)[,\s]\s*([\d.]+)(%?)"
#: Its alpha, behind a comma or slash.
_ALPHA = _CHANNELS + r"\s*[,/]\s*([\d.]+)(%?)\s*\)"
#: What a see-through or unreadable colour, a shadow without colour and one without opacity become; points of a pixel.
NO_COLOUR, SHADOW_COLOUR, SHADOW_OPACITY, POINTS = "FFFFFF", "000000", 0.5, 0.75


def rgb_to_hex(css: Column) -> Column:
    """Six hex digits of rgb() and rgba(); see-through black and unreadable colours are white."""
    def digit(k: int) -> Column:
        value, share = F.regexp_extract(css, _CHANNELS, k).try_cast("double"), F.regexp_extract(css, _CHANNELS, k + 1) == "%"
        whole = F.least(F.lit(255), F.floor(F.when(share, value * 2.55 + 0.5).otherwise(value))).cast("int")
        return F.lower(F.lpad(F.hex(whole), 2, "0"))

    clear = css.isNull() | (css == "transparent") | css.rlike(r"^rgba\(\s*0,\s*0,\s*0,\s*0\s*\)$") | ~css.rlike(_CHANNELS)
    return F.when(clear, F.lit(NO_COLOUR)).otherwise(F.concat(digit(1), digit(3), digit(5)))


def hex_to_rgb(text: Column) -> Column:
    at = lambda k: F.conv(F.substring(text, k, 2), 16, 10).cast("int")
    return F.struct(at(1).alias("r"), at(3).alias("g"), at(5).alias("b"))


def transparency(css: Column) -> Column:
    """Percent of transparency of rgba(), null for opaque notations."""
    given = F.regexp_extract(css, _ALPHA, 7).try_cast("double")
    alpha = F.when(F.regexp_extract(css, _ALPHA, 8) == "%", given / 100).otherwise(given)
    return F.floor((1 - alpha) * 100 + 0.5).cast("int")


def text_transform(text: Column, rule: Column) -> Column:
    return F.when(rule == "uppercase", F.upper(text)).when(rule == "lowercase", F.lower(text)).when(rule == "capitalize", F.array_join(F.transform(F.split(text, r"\b"), lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substring(w, 2, 1 << 30))), "")).otherwise(text)


def rotation(transform: Column, writing_mode: Column) -> Column:
    """Whole degrees from 0 to 359 of rotate() or matrix(), added to that of the writing mode; null for 0."""
    start = F.when(writing_mode == "vertical-rl", 90.0).when(writing_mode == "vertical-lr", 270.0).otherwise(0.0)
    turned = F.regexp_extract(transform, r"rotate\((-?\d+(?:\.\d+)?)deg\)", 1).try_cast("double")
    m = F.split(F.regexp_extract(transform, r"matrix\(([^)]+)\)", 1), r",\s*")
    by_matrix = F.round(F.degrees(F.atan2(F.get(m, F.lit(1)).try_cast("double"), F.get(m, F.lit(0)).try_cast("double"))), 0)
    angle = F.pmod(start + F.coalesce(turned, by_matrix, F.lit(0.0)), F.lit(360.0))
    return F.when(angle != 0, angle)


def shadow(css: Column) -> Column:
    """angle, blur, offset (points), colour and opacity of an outer box-shadow; null for none or inset."""
    size = F.regexp_extract_all(css, F.lit(r"([-\d.]+)(?:px|pt)"), F.lit(1))
    at = lambda k: F.get(size, F.lit(k)).try_cast("double")
    colour = F.regexp_extract(css, r"(rgba?\([^)]+\))", 1)
    angle = F.pmod(F.degrees(F.atan2(at(1), at(0))), F.lit(360.0))
    none = css.isNull() | (css == "none") | css.contains("inset") | (F.size(size) < 2)
    return F.when(
        ~none,
        F.struct(
            F.floor(angle + 0.5).cast("int").alias("angle"),
            (F.coalesce(at(2), F.lit(0.0)) * POINTS).alias("blur"),
            F.when(colour != "", rgb_to_hex(colour)).otherwise(F.lit(SHADOW_COLOUR)).alias("colour"),
            (F.sqrt(at(0) * at(0) + at(1) * at(1)) * POINTS).alias("offset"),
            F.coalesce(F.regexp_extract(colour, r"([\d.]+)\)$", 1).try_cast("double"), F.lit(SHADOW_OPACITY)).alias("opacity"),
        ),
    )


def rotated_box(x: Column, y: Column, w: Column, h: Column, angle: Column) -> Column:
    """The box before its rotation: sides change places at 90 and 270 degrees, the centre stays."""
    turned = angle.isin(90.0, 270.0)
    return F.when(turned, F.struct((x + w / 2 - h / 2).alias("x"), (y + h / 2 - w / 2).alias("y"), h.alias("w"), w.alias("h"))).otherwise(F.struct(x.alias("x"), y.alias("y"), w.alias("w"), h.alias("h")))
