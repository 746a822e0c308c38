"""Patterns and names that decide what the results are."""

# Fixed values.
WORD_BREAK = r"[\W_]+"  # ASCII on the JVM: splits at all but 0-9, A-Z, a-z
WORD_CHAR = r"[^\W_]"
SPACE = " "
KEY = "asin"
TEXT = "reviewText"
PRICE = "price"
TOP_ROWS = 20
TIE_PLACES = 6  # the last bits of a logarithm depend on the machine
REVIEW_COLUMNS = {
    "_c0": "int",
    "asin": "string",
    "helpful": "string",
    "overall": "double",
    "reviewText": "string",
    "reviewTime": "string",
    "reviewerID": "string",
    "reviewerName": "string",
    "summary": "string",
    "unixReviewTime": "bigint",
}
METADATA_COLUMNS = {
    "asin": "string",
    "description": "string",
    "price": "float",
    "imUrl": "string",
    "related": "string",
    "categories": "string",
    "title": "string",
    "salesRank": "string",
}
