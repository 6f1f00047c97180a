"""Scalar functions on columns: stakes, times, distances, angles, numbers and keys. All stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Mean earth radius in km, and the format of frame times (the part after the last colon is a fraction).
EARTH_KM = 6371.393
FRAME_TIME = "yyyy-MM-dd HH:mm:ss:SSS"
PREDICTED = "预测值"


def stake_to_metres(stake: Column) -> Column:
    """Metres of `K1122+849`, `AK0+649.5`: thousand times the kilometres plus the metres, truncated; null if it is none."""
    km = F.regexp_extract(stake, r"(\d+)\+([\d.]+)$", 1).try_cast("double")
    m = F.regexp_extract(stake, r"(\d+)\+([\d.]+)$", 2).try_cast("double")
    return (km * 1000 + m).cast("long")


def metres_to_stake(metres: Column, padded: bool = True, prefix: str = "K") -> Column:
    """`K1122+849`; metres within the kilometre padded to three digits unless asked otherwise."""
    m = metres.cast("long")
    return F.format_string(prefix + ("%d+%03d" if padded else "%d+%d"), F.floor(m / 1000), F.pmod(m, F.lit(1000)))


def parse_frame_time(text: Column, pad_ms: bool = False) -> Column:
    """Time of `2025-03-28 08:08:26:12`; the last part is a fraction (.12), or milliseconds if ``pad_ms``; null if bad."""
    if pad_ms:
        text = F.concat(F.substring_index(text, ":", 3), F.lit(":"), F.lpad(F.substring_index(text, ":", -1), 3, "0"))
    return F.try_to_timestamp(text, F.lit(FRAME_TIME))


def format_frame_time(ts: Column) -> Column:
    return F.date_format(ts, FRAME_TIME)


def epoch_ms(ts: Column) -> Column:
    return F.unix_millis(ts.cast("timestamp"))


def from_epoch_ms(ms: Column) -> Column:
    return F.timestamp_millis(ms)


def to_second(text: Column) -> Column:
    """`yyyy-MM-dd HH:mm:ss` of a frame time: what stands before the third colon."""
    return F.substring_index(text, ":", 3)


def slot_start(ms: Column, origin: int, width: int) -> Column:
    """Start of the slot of ``width`` ms, counted from ``origin``, that holds the time."""
    return ms - F.pmod(ms - F.lit(origin), F.lit(width))


def travelled_metres(kmh: Column, ms: Column | int) -> Column:
    """Distance in metres; null where speed or time is negative."""
    ms = F.lit(ms) if isinstance(ms, int) else ms
    return F.when((kmh >= 0) & (ms >= 0), kmh * ms / 3600)


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    a, b = F.radians(lat1), F.radians(lat2)
    h = F.pow(F.sin((b - a) / 2), 2) + F.cos(a) * F.cos(b) * F.pow(F.sin((F.radians(lon2) - F.radians(lon1)) / 2), 2)
    return F.lit(2 * EARTH_KM) * F.atan2(F.sqrt(h), F.sqrt(F.greatest(1 - h, F.lit(0.0))))


def bearing(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Initial bearing from the first point to the second, 0 to 360 degrees."""
    a, b, d = F.radians(lat1), F.radians(lat2), F.radians(lon2 - lon1)
    y, x = F.sin(d) * F.cos(b), F.cos(a) * F.sin(b) - F.sin(a) * F.cos(b) * F.cos(d)
    return F.pmod(F.degrees(F.atan2(y, x)) + 360, F.lit(360.0))


def segment_angle(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Angle in degrees between two vectors; null if one has no length."""
    length = F.sqrt(x1 * x1 + y1 * y1) * F.sqrt(x2 * x2 + y2 * y2)
    cosine = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), (x1 * x2 + y1 * y2) / F.nullif(length, F.lit(0.0))))
    return F.when(length > 0, F.degrees(F.acos(cosine)))


def is_peak_hour(ts: Column) -> Column:
    """From 7 to 9 and from 17 to 19 o'clock, ends excluded."""
    h = F.hour(ts)
    return ((h >= 7) & (h < 9)) | ((h >= 17) & (h < 19))


def decimals(value: Column, digits: int) -> Column:
    """Text with so many decimals, halves to even."""
    return F.format_string(f"%.{digits}f", F.bround(value, digits))


def strip_brackets(text: Column) -> Column:
    return F.regexp_replace(text, r"^\[|\]$", "")


def mark_predicted(plate: Column) -> Column:
    """Plate with the mark of a predicted point; a marked one keeps its first seven characters and one mark."""
    return F.when(plate.endswith("值"), F.concat(F.substring(plate, 1, 7), F.lit(" " + PREDICTED))).otherwise(F.concat(plate, F.lit(" " + PREDICTED)))


def unmark_predicted(plate: Column) -> Column:
    return F.regexp_replace(plate, f" ?{PREDICTED}$", "")


def road_code(stake: Column) -> Column:
    """AK, BK, CK, DK or K; empty if the stake has no such prefix."""
    return F.regexp_extract(stake, "^([A-D]?K)", 1)


def section_id(stake: Column) -> Column:
    """Ten-kilometre section of a mainline stake, -1 for ramps and what can't be read."""
    return F.coalesce(F.when(stake.rlike(r"^K\d"), F.floor(stake_to_metres(stake) / 10000)), F.lit(-1)).cast("int")


def vehicle_class(kind: Column) -> Column:
    """0 for coaches and cars (1-4, 7, 15), 1 for lorries (8, 10, 11, 170-177), else -1."""
    return F.when(kind.isin(1, 2, 3, 4, 7, 15), 0).when(kind.isin(8, 10, 11) | kind.between(170, 177), 1).otherwise(-1)


def is_mainline(stake: Column) -> Column:
    return F.coalesce((stake != "") & ~stake.rlike("^[ABCD]"), F.lit(False))


def trajectory_key(start_ms: Column, plate: Column, vehicle: Column) -> Column:
    return F.concat_ws("-", start_ms, plate, vehicle)


def hour_section_key(ts: Column, section: Column) -> Column:
    return F.concat_ws("-", F.date_format(ts, "yyyyMMddHH"), section)


def minute_km_key(ts: Column, km: Column) -> Column:
    return F.concat(F.date_format(ts, "yyyyMMddHHmm"), F.lit("_K"), km)


def most_frequent_key(counts: Column) -> Column:
    """Key of the largest value of a map (ties: the smallest key)."""
    ranked = F.array_sort(F.transform(F.map_entries(counts), lambda e: F.struct((-e["value"]).alias("n"), e["key"].alias("k"))))
    return F.try_element_at(ranked, F.lit(1))["k"]


def hex_to_number(text: Column) -> Column:
    return F.conv(text, 16, 10).cast("long")


def xor_of_hex(digits: Column) -> Column:
    """Exclusive-or of all bytes that the hex digits spell; 0 for none."""
    return xor_of_bytes(F.unhex(F.when(F.length(digits) % 2 == 1, F.concat(digits, F.lit("0"))).otherwise(digits)))


def xor_of_bytes(data: Column) -> Column:
    """Exclusive-or of all bytes of a binary column, eight at a time; 0 for none. Words are cut from bytes: in a text each would
    be looked for from the beginning."""

    def whole(d: Column) -> Column:
        words = F.ceil(F.length(d) / 8).cast("int")
        word = lambda k: F.conv(F.rpad(F.hex(F.substring(d, k * 8 + 1, F.lit(8))), 16, F.lit("0")), 16, -10).cast("long")
        every = F.when(words > 0, F.sequence(F.lit(0), words - 1)).otherwise(F.array().cast("array<int>"))
        return F.aggregate(every, F.lit(0).cast("long"), lambda acc, k: acc.bitwiseXOR(word(k)), _folded)

    return F.get(F.transform(F.array(data), whole), 0)  # the bytes are made once a row


def _folded(v: Column) -> Column:
    """Exclusive-or of the eight bytes of a number."""
    for bits in (32, 16, 8):
        v = v.bitwiseXOR(F.shiftrightunsigned(v, bits))
    return v.bitwiseAND(F.lit(255).cast("long"))


def little_endian(data: Column, offset: Column | int, size: int) -> Column:
    """Unsigned number (signed for 8 bytes) of ``size`` bytes from a zero-based offset of a binary column."""
    offset = F.lit(offset) if isinstance(offset, int) else offset
    digits = F.concat(*[F.hex(F.substring(data, offset + k + 1, F.lit(1))) for k in range(size - 1, -1, -1)])
    return _number(digits, size)


def big_endian(data: Column, offset: Column | int, size: int) -> Column:
    offset = F.lit(offset) if isinstance(offset, int) else offset
    return _number(F.hex(F.substring(data, offset + 1, F.lit(size))), size)


def _number(digits: Column, size: int) -> Column:
    if size < 8:
        return F.conv(digits, 16, 10).cast("long")
    high, low = F.conv(F.substring(digits, 1, 8), 16, 10).cast("long"), F.conv(F.substring(digits, 9, 8), 16, 10).cast("long")
    return F.shiftleft(high, 32).bitwiseOR(low)


def signed(value: Column, size: int) -> Column:
    """Two's complement of an unsigned number of so many bytes."""
    return F.when(value >= (1 << (8 * size - 1)), value - (1 << (8 * size))).otherwise(value)


def float_of_bits(bits: Column) -> Column:
    """The IEEE single-precision number with these 32 bits, as a double (normal, subnormal and zero)."""
    sign = F.when(F.shiftright(bits, 31).bitwiseAND(F.lit(1)) == 1, -1.0).otherwise(1.0)
    exponent = F.shiftright(bits, 23).bitwiseAND(F.lit(255))
    mantissa = bits.bitwiseAND(F.lit(0x7FFFFF)).cast("double")
    normal = (1 + mantissa / float(1 << 23)) * F.pow(F.lit(2.0), exponent - 127)
    return sign * F.when(exponent == 0, mantissa * 2.0**-149).when(exponent < 255, normal)
