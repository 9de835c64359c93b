"""One schema per table.  Review text is ``text``; the feature tables keep the
user columns and the source address; token counts are integers."""

from __future__ import annotations

SCRAPED_REVIEW = (
    "name string, address string, category string, overall_rating double, "
    "review_count int, website string, google_maps_url string, lat double, lng double, "
    "author string, review_rating int, review_text string, relative_time string, "
    "date_retrieved date, calculated_date timestamp, review_id string"
)
ALT_REVIEW = (
    "business_name string, author_name string, text string, photo string, "
    "rating double, rating_category string"
)
PLACE = (
    "place_id string, name string, category string, address string, url string, "
    "lat double, lng double, avg_rating double, num_reviews int"
)
USERS = "user_id string, name string, part int, reviews array<string>"
REVIEW = (
    "review_id string, place_id string, user_id string, user_name string, rating double, "
    "text string, language string, timestamp timestamp"
)
PAGES = "page_id bigint, url string, html string"
PROFILE = (
    "name string, address string, category string, overall_rating double, "
    "review_count int, website string, google_maps_url string, lat double, lng double, "
    "reviews array<struct<author_name string, rating int, text string, "
    "relative_time string, review_id string>>"
)
# Required fields and their types for the record check.
REVIEW_RULES = {
    "review_id": "string", "place_id": "string", "user_id": "string",
    "user_name": "string", "rating": "double", "text": "string",
    "language": "string", "timestamp": "timestamp",
}
PLACE_RULES = {
    "place_id": "string", "name": "string", "category": "string", "address": "string",
    "url": "string", "lat": "double", "lng": "double", "avg_rating": "double",
    "num_reviews": "int",
}
USER_RULES = {"user_id": "string", "name": "string", "reviews": "array<string>"}
