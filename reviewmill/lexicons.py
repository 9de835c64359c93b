"""Small default word tables.  Every job takes its table as a parameter; these
defaults only make the jobs usable without one."""

from __future__ import annotations

import unicodedata
from functools import cache

from pyspark.sql import DataFrame, SparkSession

# Keywords per business category; another table is read with
# ``read_aspects`` and passed in.
ASPECTS = {
    "restaurant": [
        "food", "menu", "taste", "delicious", "flavor", "fresh", "dish", "cuisine",
        "ingredients", "price", "cost", "bill", "value", "service", "staff", "waiter",
        "server", "friendly", "table", "waiting", "reservation", "booking", "ambience",
        "atmosphere", "vibe", "decor", "clean", "hygiene", "facility", "restroom",
    ],
    "cafe": [
        "coffee", "espresso", "latte", "brew", "drink", "beverage", "tea", "dessert",
        "pastry", "cake", "wifi", "internet", "power outlet", "work", "ambience", "vibe",
        "music", "seat", "table", "price", "affordable", "service", "staff",
    ],
    "hotel": [
        "room", "bed", "pillow", "sleep", "bathroom", "shower", "amenities", "clean",
        "tidy", "housekeeping", "staff", "reception", "concierge", "check-in", "location",
        "view", "nearby", "walking", "facility", "pool", "gym", "elevator", "parking",
        "breakfast", "buffet", "service", "price",
    ],
    "bar": [
        "drink", "cocktail", "beer", "wine", "alcohol", "liquor", "menu", "music", "dj",
        "band", "crowd", "busy", "lively", "price", "happy hour", "service", "bartender",
        "staff", "ambience", "atmosphere", "vibe", "decor", "lighting",
    ],
    "gym": [
        "equipment", "machine", "weights", "cardio", "clean", "locker", "shower", "hygiene",
        "trainer", "coach", "staff", "facility", "pool", "sauna", "crowd", "busy", "peak",
        "price", "membership", "subscription", "class", "workout", "session", "service",
    ],
    "supermarket": [
        "product", "item", "grocery", "stock", "variety", "selection", "inventory", "price",
        "cheap", "freshness", "produce", "fruit", "vegetable", "meat", "staff", "cashier",
        "queue", "line", "checkout", "location", "parking", "clean", "aisle",
    ],
    "park": [
        "nature", "tree", "grass", "trail", "path", "clean", "litter", "maintenance",
        "facility", "bench", "playground", "toilet", "crowd", "quiet", "peaceful",
        "ambience", "atmosphere", "safety", "security", "lighting", "location", "parking",
        "view",
    ],
    "museum": [
        "exhibit", "collection", "display", "art", "history", "gallery", "staff", "guide",
        "info", "facility", "elevator", "cafe", "shop", "crowd", "tourist", "noise", "price",
        "admission", "ticket", "ambience", "lighting", "atmosphere", "location", "artifact",
        "admission", "fee",
    ],
    "shopping_mall": [
        "store", "brand", "shop", "boutique", "variety", "selection", "price", "sale",
        "food court", "facility", "restroom", "elevator", "escalator", "parking", "crowd",
        "busy", "vibe", "ambience", "decor", "location", "accessible",
    ],
    "cinema": [
        "movie", "film", "screening", "seat", "comfort", "legroom", "sound", "audio",
        "screen", "visual", "imax", "3d", "price", "ticket", "popcorn", "snack",
        "concession", "crowd", "facility", "clean", "staff",
    ],
    "airport": [
        "terminal", "gate", "lounge", "facility", "duty free", "shop", "restaurant", "staff",
        "customs", "immigration", "queue", "wait", "line", "security", "check-in",
        "location", "transport", "shuttle", "clean", "service", "ambience", "signage",
    ],
    "school": [
        "teacher", "instructor", "faculty", "staff", "admin", "principal", "facility",
        "classroom", "lab", "library", "playground", "location", "campus", "class",
        "lesson", "course", "clean", "environment", "ambience", "atmosphere", "service",
        "school fee", "hall",
    ],
}

# Path words tried on every site.
SITE_PATHS = [
    "about", "about-us", "our-story", "story", "company", "mission", "vision", "values",
    "services", "menu", "team", "philosophy", "brand",
]

# File endings that are not pages.
BINARY_EXTENSIONS = [".pdf", ".jpg", ".png", ".docx", ".zip"]

# A page holding one of these is an error page.
ERROR_PHRASES = [
    "page you requested was not found", "404", "not found on this server",
    "sorry, the page",
]

# A line holding one of these is a cookie notice.
COOKIE_PHRASES = [
    "use cookies to provide", "accept our use of cookies", "decline cookies at any time",
    "adjust your settings", "function properly", "signing in, or filling in forms",
]

# Elements removed with everything inside them.
DROPPED_TAGS = ["script", "style", "noscript", "footer", "header", "nav", "aside"]

# Seconds per unit of a relative time (month 30 days, year 365).
UNIT_SECONDS = {
    "minute": 60, "hour": 3600, "day": 86400, "week": 604800,
    "month": 2592000, "year": 31536000,
}

# Code points that are emoji, as "first" or "first-last" in hexadecimal.
EMOJI_RANGES = (
    "a9 ae 203c 2049 2122 2139 2194-2199 21a9-21aa 231a-231b 2328 23cf 23e9-23f3 23f8-23fa 24c2 25aa-25ab 25b6 25c0 "
    "25fb-25fe 2600-2604 260e 2611 2614-2615 2618 261d 2620 2622-2623 2626 262a 262e-262f 2638-263a 2640 2642 2648-2653 "
    "265f-2660 2663 2665-2666 2668 267b 267e-267f 2692-2697 2699 269b-269c 26a0-26a1 26a7 26aa-26ab 26b0-26b1 26bd-26be "
    "26c4-26c5 26c8 26ce-26cf 26d1 26d3-26d4 26e9-26ea 26f0-26f5 26f7-26fa 26fd 2702 2705 2708-270d 270f 2712 2714 2716 "
    "271d 2721 2728 2733-2734 2744 2747 274c 274e 2753-2755 2757 2763-2764 2795-2797 27a1 27b0 27bf 2934-2935 2b05-2b07 "
    "2b1b-2b1c 2b50 2b55 3030 303d 3297 3299 1f004 1f0cf 1f170-1f171 1f17e-1f17f 1f18e 1f191-1f19a 1f201-1f202 1f21a "
    "1f22f 1f232-1f23a 1f250-1f251 1f300-1f321 1f324-1f393 1f396-1f397 1f399-1f39b 1f39e-1f3f0 1f3f3-1f3f5 1f3f7-1f3fa "
    "1f400-1f4fd 1f4ff-1f53d 1f549-1f54e 1f550-1f567 1f56f-1f570 1f573-1f57a 1f587 1f58a-1f58d 1f590 1f595-1f596 "
    "1f5a4-1f5a5 1f5a8 1f5b1-1f5b2 1f5bc 1f5c2-1f5c4 1f5d1-1f5d3 1f5dc-1f5de 1f5e1 1f5e3 1f5e8 1f5ef 1f5f3 1f5fa-1f64f "
    "1f680-1f6c5 1f6cb-1f6d2 1f6d5-1f6d7 1f6dc-1f6e5 1f6e9 1f6eb-1f6ec 1f6f0 1f6f3-1f6fc 1f7e0-1f7eb 1f7f0 1f90c-1f93a "
    "1f93c-1f945 1f947-1f9ff 1fa70-1fa7c 1fa80-1fa88 1fa90-1fabd 1fabf-1fac5 1face-1fadb 1fae0-1fae8 1faf0-1faf8"
)
# Skin tones, and the people and signs that joined emoji are made of.
SKIN_TONES = {
    "\U0001f3fb": "light_skin_tone", "\U0001f3fc": "medium-light_skin_tone", "\U0001f3fd": "medium_skin_tone",
    "\U0001f3fe": "medium-dark_skin_tone", "\U0001f3ff": "dark_skin_tone",
}
EMOJI_PEOPLE = {"👨": "man", "👩": "woman", "🧑": "person", "👧": "girl", "👦": "boy"}
EMOJI_GENDERS = {"♀": "woman", "♂": "man"}
EMOJI_ROLES = {
    "⚕": "health_worker", "🎓": "student", "🏫": "teacher", "⚖": "judge", "🌾": "farmer", "🍳": "cook", "🔧": "mechanic",
    "🏭": "factory_worker", "💼": "office_worker", "🔬": "scientist", "💻": "technologist", "🎤": "singer", "🎨": "artist",
    "✈": "pilot", "🚀": "astronaut", "🚒": "firefighter",
}
# Names that differ from the character's own, and joined emoji with a name of their own.
EMOJI_NAMES = {
    "🏳\u200d🌈": "rainbow_flag", "🏴\u200d☠": "pirate_flag", "❤\u200d🔥": "heart_on_fire", "❤\u200d🩹": "mending_heart",
    "👁\u200d🗨": "eye_in_speech_bubble", "🐻\u200d❄": "polar_bear", "🐕\u200d🦺": "service_dog",
    "😀": "grinning_face", "😁": "beaming_face_with_smiling_eyes",
    "😂": "face_with_tears_of_joy", "😄": "grinning_face_with_smiling_eyes",
    "😊": "smiling_face_with_smiling_eyes", "😋": "face_savoring_food",
    "😍": "smiling_face_with_heart-eyes", "😎": "smiling_face_with_sunglasses",
    "😐": "neutral_face", "😞": "disappointed_face", "😡": "enraged_face",
    "😢": "crying_face", "😭": "loudly_crying_face", "🤔": "thinking_face",
    "🤢": "nauseated_face", "🤩": "star-struck", "👍": "thumbs_up", "👎": "thumbs_down",
    "👏": "clapping_hands", "🙏": "folded_hands", "❤": "red_heart", "💔": "broken_heart",
    "⭐": "star", "🌟": "glowing_star", "🎉": "party_popper", "🔥": "fire",
    "💯": "hundred_points", "🍕": "pizza", "🍔": "hamburger", "🍜": "steaming_bowl",
    "🍣": "sushi", "🍰": "shortcake", "🍷": "wine_glass", "🍺": "beer_mug", "☕": "hot_beverage",
}

# Our own small polarity list for the sentiment column.
POLARITY = {
    "good": 0.7, "great": 0.8, "excellent": 1.0, "nice": 0.6, "friendly": 0.5,
    "clean": 0.4, "delicious": 0.9, "happy": 0.8, "helpful": 0.6, "love": 0.8,
    "bad": -0.7, "terrible": -1.0, "dirty": -0.6, "rude": -0.8, "slow": -0.4,
    "poor": -0.6, "worst": -1.0, "cold": -0.2, "hate": -0.8, "disappointing": -0.7,
}


@cache
def emoji_names() -> dict[str, str]:
    """Every emoji of one code point with the name its character has, and EMOJI_NAMES on top."""
    found = {}
    for part in EMOJI_RANGES.split():
        first, _, last = part.partition("-")
        for code in range(int(first, 16), int(last or first, 16) + 1):
            name = unicodedata.name(chr(code), "")
            if name:
                found[chr(code)] = name.lower().replace(" ", "_").replace("-", "_")
    return {**found, **EMOJI_NAMES}


def aspects(spark: SparkSession, table: dict[str, list[str]] | None = None) -> DataFrame:
    """(category, keyword) rows; repeated keywords of a category count once."""
    table = ASPECTS if table is None else table
    rows = [(cat, kw) for cat, kws in table.items() for kw in dict.fromkeys(kws)]
    return spark.createDataFrame(rows, "category string, keyword string")


def read_aspects(spark: SparkSession, path: str) -> DataFrame:
    """A (category, keyword) CSV with a header line."""
    return (
        spark.read.schema("category string, keyword string").csv(path, header=True).distinct()
    )


def polarity(spark: SparkSession, table: dict[str, float] | None = None) -> DataFrame:
    table = POLARITY if table is None else table
    return spark.createDataFrame(list(table.items()), "word string, score double")
