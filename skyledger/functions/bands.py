"""Index bands: levels, codes, alert severities, colours and advice."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Upper edge of each band (the last band is open) and its labels.
BAND_EDGES = (50, 100, 150, 200, 300)
LEVEL_NAMES = (
    "Good",
    "Moderate",
    "Unhealthy for Sensitive Groups",
    "Unhealthy",
    "Very Unhealthy",
    "Hazardous",
)
LEVEL_CODES = (
    "GOOD",
    "MODERATE",
    "UNHEALTHY_SENSITIVE",
    "UNHEALTHY",
    "VERY_UNHEALTHY",
    "HAZARDOUS",
)
LOCAL_LEVELS = (
    "Tốt",
    "Trung bình",
    "Không tốt cho nhóm nhạy cảm",
    "Không tốt",
    "Rất không tốt",
    "Nguy hại",
)
DISPLAY_LEVELS = (*LOCAL_LEVELS[:5], "Nguy hiểm")
NO_DATA_LEVEL = "Không có dữ liệu"
ALERT_SEVERITIES = (None, None, "MEDIUM", "HIGH", "CRITICAL", "CRITICAL")
# Colour of each band as red, green, blue and opacity.
BAND_COLORS = (
    (34, 197, 94, 225),
    (234, 179, 8, 230),
    (249, 115, 22, 230),
    (220, 38, 38, 230),
    (147, 51, 234, 230),
    (127, 29, 29, 235),
)
NO_DATA_COLOR = (148, 163, 184, 210)
# Health advice of each band, title, body and colour.
ADVICE_TITLES = (
    "Sinh hoạt ngoài trời bình thường",
    "Hầu hết mọi người có thể sinh hoạt bình thường",
    "Nhóm nhạy cảm nên giảm hoạt động ngoài trời",
    "Nên giảm thời gian vận động ngoài trời",
    "Hạn chế ra ngoài khi không cần thiết",
    "Tránh hoạt động ngoài trời",
)
NO_DATA_ADVICE = "Chưa thể đưa ra khuyến nghị"
ADVICE_BODIES = (
    "Chất lượng không khí đang ở mức tốt. Hầu hết mọi người có thể "
    "sinh hoạt và vận động ngoài trời như bình thường.",
    "Người đặc biệt nhạy cảm nên theo dõi cơ thể và giảm hoạt động "
    "kéo dài ngoài trời nếu cảm thấy khó chịu.",
    "Trẻ em, người lớn tuổi và người có bệnh tim hoặc hô hấp nên "
    "giảm hoạt động kéo dài hoặc gắng sức ngoài trời.",
    "Mọi người nên giảm hoạt động kéo dài hoặc gắng sức ngoài trời. "
    "Nhóm nhạy cảm cần hạn chế nhiều hơn.",
    "Nên tránh vận động gắng sức ngoài trời. Nhóm nhạy cảm nên ở "
    "trong nhà khi có thể và theo dõi khuyến cáo chính thức.",
    "Mọi người nên tránh hoạt động ngoài trời và theo dõi cảnh báo "
    "môi trường hoặc hướng dẫn y tế chính thức.",
)
NO_DATA_BODY = "Hiện chưa có đủ dữ liệu AQI để đánh giá mức chất lượng không khí."
ADVICE_COLORS = ("#22c55e", "#eab308", "#f97316", "#dc2626", "#9333ea", "#7f1d1d")
NO_DATA_ADVICE_COLOR = "#64748b"
# Fixed value: text of an alert.
ALERT_MESSAGE = "Cảnh báo chất lượng không khí: %s (%s) có US AQI=%d, mức '%s'."


def by_band(value: Column, choices, missing: Column | None = None) -> Column:
    """Pick one of six literals by band; a missing value gives ``missing``."""
    chain = F.when(value.isNull() | F.isnan(value), missing if missing is not None else F.lit(None))
    for edge, choice in zip(BAND_EDGES, choices):
        chain = chain.when(value <= edge, choice)
    return chain.otherwise(choices[-1])


def _literals(values) -> list[Column]:
    return [F.lit(value) for value in values]


def level_name(value: Column) -> Column:
    return by_band(value, _literals(LEVEL_NAMES))


def level_rank(value: Column) -> Column:
    return by_band(value, _literals(range(1, 7)))


def level_code(value: Column) -> Column:
    return by_band(value, _literals(LEVEL_CODES))


def local_level(value: Column) -> Column:
    return by_band(value, _literals(LOCAL_LEVELS))


def display_level(value: Column) -> Column:
    return by_band(value, _literals(DISPLAY_LEVELS), F.lit(NO_DATA_LEVEL))


def alert_severity(value: Column) -> Column:
    return by_band(value, [F.lit(s).cast("string") for s in ALERT_SEVERITIES])


def classification_error(value: Column) -> Column:
    """Why a text or number cannot be classified strictly; null if it can.

    Strict classification accepts a missing value, but no text that is not a
    number, no fraction and no negative index.
    """
    number = value.try_cast("double")
    return (
        F.when(value.isNull(), F.lit(None))
        .when(number.isNull() | F.isnan(number), F.lit("NOT_A_NUMBER"))
        .when(number % 1 != 0, F.lit("FRACTIONAL"))
        .when(number < 0, F.lit("NEGATIVE"))
    )


def strict_value(value: Column) -> Column:
    """The index as an integer; a value that cannot be classified stops the job."""
    error = classification_error(value)
    return F.when(
        error.isNotNull(), F.raise_error(F.concat(F.lit("index cannot be classified: "), error))
    ).otherwise(value.try_cast("double").cast("int"))


def alert_message(point_id: Column, location_id: Column, value: Column) -> Column:
    return F.when(
        alert_severity(value).isNotNull(),
        F.format_string(ALERT_MESSAGE, point_id, location_id, value.cast("int"), local_level(value)),
    )


def _color(channels) -> Column:
    return F.array(*[F.lit(channel) for channel in channels])


def fill_color(value: Column) -> Column:
    return by_band(value, [_color(c) for c in BAND_COLORS], _color(NO_DATA_COLOR))


def marker_radius(value: Column) -> Column:
    """Map marker size: the index clipped to 0..300, scaled to metres."""
    clipped = F.least(F.greatest(F.coalesce(value, F.lit(0.0)), F.lit(0.0)), F.lit(300.0))
    return clipped * 110 + 22000


def advice(value: Column) -> Column:
    """Health advice as a struct of title, body and colour."""

    def entry(title: str, body: str, color: str) -> Column:
        return F.struct(
            F.lit(title).alias("title"), F.lit(body).alias("body"), F.lit(color).alias("color")
        )

    entries = [entry(*texts) for texts in zip(ADVICE_TITLES, ADVICE_BODIES, ADVICE_COLORS)]
    return by_band(value, entries, entry(NO_DATA_ADVICE, NO_DATA_BODY, NO_DATA_ADVICE_COLOR))
