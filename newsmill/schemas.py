"""Record layouts, as DDL strings."""

# One normalised article. (source_ord, pos) is the input position: source_ord
# numbers the source type (0 to 7) and pos is unique inside it.
ARTICLE = """
    id string, title string, url string, source string, source_type string,
    content string, published_at timestamp, scraped_at timestamp,
    source_ord int, pos bigint
"""

ANALYZED = (
    ARTICLE
    + """,
    summary string, severity string,
    relevance struct<category: string, score: int, reasoning: string>,
    affected_products array<string>
"""
)

SOURCE_REGISTRY = """
    rss array<struct<name: string, url: string, enabled: boolean>>,
    apis array<struct<name: string, type: string, enabled: boolean>>,
    social array<struct<name: string, platform: string, handle: string, enabled: boolean>>
"""

# Landed documents, one fetched body per row; doc_pos is the fetch order.
LANDED = "source_name string, body string, scraped_at timestamp, doc_pos bigint"

RESPONSE = "id string, response_text string"
SENT_ID = "id string, sent_date date"

# Source types in the order in which a run reads them.
SOURCE_TYPES = ("rss", "nvd", "arxiv", "x")
