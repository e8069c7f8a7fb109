"""Table schemas, as DDL strings that Spark readers take."""

SEEDS = "seed_ord bigint, url string"
TASKS = "url string, origin_url string, depth int"
RESPONSES = "url string, status_code int, content_type string, body string, error string"
ROBOTS = "host_key string, status_code int, body string"
EDGES = "src string, dst string"
VISITED = "url string, origin_url string, depth int, discovered_at timestamp"
PAGES = (
    "url string, origin_url string, depth int, title string, content string, "
    "status_code int, error string, fetched_at timestamp"
)
FRONTIER_CHECKPOINT = "url string, origin_url string, depth int, seed_ord bigint, saved_at timestamp"
WORD_POSTINGS = "word string, url string, origin_url string, depth int, frequency int"
TEXT_POSTINGS = "term string, url string, field string, pos int, n_tokens int"
TEXT_DOCUMENTS = "url string, origin_url string, depth int, n_tokens int"
