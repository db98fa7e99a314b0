"""Fixed values.

Everything in this module is data that results depend on: labels, thresholds, word lists and
formats. Nothing here is computed.
"""

TIME_ZONE = "America/New_York"
CITY = "Philadelphia"

# Category label, log slug and default event length in minutes, in display order.
CATEGORIES = [
    ("🎵 Music & Concerts", "music", 180),
    ("🎬 Film & Cinema", "film", 120),
    ("📚 Literary", "literary", 90),
    ("🤝 Community & Politics", "community", 120),
    ("🎨 Arts & Workshops", "arts", 120),
    ("💻 Tech & Maker", "tech", 120),
    ("🌿 Markets & Outdoors", "outdoors", 120),
    ("👻 Horror & Occult", "horror", 120),
    ("🎪 Festivals & Major Events", "festival", 360),
]
DEFAULT_EVENT_MINUTES = 120
COMMUNITY = "🤝 Community & Politics"

# Sources that win an exact-duplicate collapse, best first; all others share the last rank.
SOURCE_PRIORITY = ["R5 Productions", "PhilaMOCA", "Philly Ask A Punk", "Do215"]

RECURRING_DATES = 3
DESCRIPTION_CHARS = 600
SOLD_OUT_PHRASE = "sold out"
SOLD_OUT_NOTE = "[Note: at least one other source reports this as sold out.] "
SOLD_OUT_SUFFIX = "(SOLD OUT)"
ELLIPSIS = "…"
UNKNOWN_REASON = "unknown reason"
COST_NOT_LISTED = "Not listed"
FREE_WORDS = ["free", "no cover"]
LOW_PRICE_BELOW = 15.0
VENUE_PICKS_PER_WEEK = 2
PICKS_PER_DAY = 3
MENTIONS_PER_DAY = 3
CARDS_PER_CATEGORY = 10
NIGHT_HOURS = (0, 6)
FUZZY_RATIO = 0.6
BODY_CHARS = 200_000
TRUNCATION_MARK = "\n\n[... truncated at {n} chars ...]"
SERIES_SEPARATORS = [":", " - ", "—"]
VARIOUS_TIMES = "Various"
MULTIPLE_SHOWTIMES = "multiple showtimes"
ONLINE_ANY = "(online)"
ONLINE_SEE_DESCRIPTION = "(online / see description)"

# Patterns of dates, times, prices and name separators.
SINGLE_CLOCK = r"^\d{1,2}:\d{2} [AP]M$"
DOLLARS = r"\$(\d+(?:\.\d+)?)"
ACT_SEPARATORS = r"(?i)\s*(?:,| & | and | w/ | with | — | – | - )\s*"
DATE_AT_TIME = r"(?i)([a-z]+)\s+(\d{1,2}),\s*(\d{4})\s*@\s*(\d{1,2}):(\d{2})\s*(am|pm)"
WEEKDAY_DATE = r"\w{3},?\s+(\w{3})\s+(\d{1,2})"
LONG_DATE = r"(\w+)\s+(\d{1,2}),?\s*(\d{4})?"
FULL_DATE = r"(\w+)\s+(\d{1,2}),?\s+(\d{4})"
TIME_IN_TEXT = r"\d{1,2}:\d{2}\s*[AP]M"
TIME_AT_START = r"\A\s*([\d:]+\s*[AP]M)"
SHOW_TIME = r"\b(\d{1,2}):(\d{2})([ap])\b"
NEARBY_LINE = "\nNEARBY THEATERS"

MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]

# Text shown while a page is still behind a bot check.
CHALLENGE_MARKERS = [
    "checking your browser",
    "just a moment",
    "please wait while we verify",
    "performing security verification",
]

# Documents that live beside the source files of a week but are not source files.
DERIVED_FILES = [
    "_manifest.json",
    "_candidates.json",
    "_selection_annotations.json",
    "_selections.json",
    "_spotify.json",
]

PICKS_LOG_COLUMNS = [
    "city", "week_of", "day", "date", "title", "venue", "category",
    "source", "rank", "price_tier", "spotify_link", "tags", "attended",
]

USAGE_FIELDS = [
    "input_tokens",
    "cache_creation_input_tokens",
    "cache_read_input_tokens",
    "output_tokens",
]
# Relative price of one unit of each usage field.
USAGE_WEIGHTS = {
    "input_tokens": 1.0,
    "cache_creation_input_tokens": 1.25,
    "cache_read_input_tokens": 0.1,
    "output_tokens": 5.0,
}

# Smallest believable weekly yield per source; sources not named have no floor.
YIELD_FLOORS = {
    "do215": 20,
    "iffy-books": 3,
    "luma": 5,
    "philadelphia-film-society": 6,
    "philamoca": 4,
    "philly-ask-a-punk": 4,
    "phillygoth": 2,
    "r5-productions": 2,
    "the-rotunda": 1,
    "trakt-film-releases": 1,
    "wooden-shoe-books": 2,
    "wxpn": 15,
}
TOTAL_YIELD_FLOOR = 45

# File stem, display name and payload format of every collected source.
SOURCES = [
    ("philly-ask-a-punk", "Philly Ask A Punk", "epoch_json"),
    ("luma", "Luma", "ical_utc"),
    ("r5-productions", "R5 Productions", "html_tagline"),
    ("philamoca", "PhilaMOCA", "html_dated"),
    ("cinespeak", "cinéSPEAK", "html_blocks"),
    ("phillygoth", "Phillygoth.net", "html_long_date"),
    ("philly-shows", "Philly-Shows.com", "html_two_fields"),
    ("the-rotunda", "The Rotunda", "html_month_grid"),
    ("meetup-philadelphia-horror-meetup-group", "Meetup: Philadelphia Horror", "ical_local"),
    ("meetup-code-coffee", "Meetup: Code & Coffee", "ical_local"),
    ("meetup-ai-philly", "Meetup: AI Philly", "ical_local"),
    ("meetup-tech-in-motion", "Meetup: Tech in Motion", "ical_local"),
    ("meetup-dc215", "Meetup: DC 215", "ical_local"),
    ("meetup-owasp", "Meetup: OWASP", "ical_local"),
    ("meetup-philly-hardware", "Meetup: Philly Hardware", "ical_local"),
    ("meetup-philly-film-club", "Meetup: Philly Film Club", "ical_local"),
    ("do215", "Do215", "object_json"),
    ("wxpn", "WXPN", "date_only_json"),
    ("lightbox-film-center", "Lightbox Film Center", "json_ld"),
    ("philadelphia-film-society", "Philadelphia Film Society", "showtime_text"),
    ("iffy-books", "Iffy Books", "calendar_json"),
    ("wooden-shoe-books", "Wooden Shoe Books", "calendar_json"),
    ("trakt-film-releases", "Trakt.tv film releases", "calendar_json"),
]

# Link prefixes and fallback links of the feeds.
LINKS = {
    "object_json": "https://do215.com",
    "epoch_json": "https://philly.askapunk.net/",
    "html_dated": "https://www.philamoca.org/",
    "html_blocks": "https://cinespeak.org/cinema/",
    "html_tagline": "https://r5productions.com/events/",
    "html_two_fields": "https://www.philly-shows.com/",
    "html_month_grid": "https://www.therotunda.org",
}

# Feeds that cover one venue only.
VENUE_OF_FORMAT = {
    "html_dated": "PhilaMOCA, 531 N 12th St, Philadelphia, PA 19123",
    "html_month_grid": "The Rotunda, 4014 Walnut St, Philadelphia, PA 19104",
}

# Street addresses of venues that have no feed of their own.
VENUE_ADDRESSES = {
    "First Unitarian Church": "2125 Chestnut St, Philadelphia, PA 19103",
    "Kung Fu Necktie": "1248 N Front St, Philadelphia, PA 19122",
    "Underground Arts": "1200 Callowhill St, Philadelphia, PA 19123",
    "Head House Books": "619 S 2nd St, Philadelphia, PA 19147",
    "Big Blue Marble Bookstore": "551 Carpenter Ln, Philadelphia, PA 19119",
    "Ortlieb's": "847 N 3rd St, Philadelphia, PA 19123",
    "Johnny Brenda's": "1201 N Frankford Ave, Philadelphia, PA 19125",
    "Cousin Danny's": "5001 Market St, Philadelphia, PA 19139",
    "Ruba Club": "416 Green St, Philadelphia, PA 19123",
    "Warehouse on Watts": "923 N Watts St, Philadelphia, PA 19123",
    "Ukie Club": "847 N Franklin St, Philadelphia, PA 19123",
    "Pennhurst Asylum": "601 N Church St, Spring City, PA 19475",
}

# Venues that win a tie between otherwise equal picks.
ELEVATED_VENUES = [
    "PhilaMOCA",
    "Iffy Books",
    "Harriet's Bookshop",
    "The Rotunda",
    "Wooden Shoe Books",
    "First Unitarian Church",
    "Lightbox Film Center",
]

# Interest, tier (1 core, 2 strong, 3 flavour) and the words that signal it.
INTERESTS = [
    ("leftist politics", 1, ["labor", "union", "indigenous", "solidarity", "anarchist", "justice"]),
    ("film", 1, ["film", "screening", "cinema", "noir", "shorts"]),
    ("punk and hardcore", 1, ["punk", "hardcore", "ebm", "industrial", "noise", "emo", "post punk", "post hardcore"]),
    ("horror and occult", 1, ["horror", "paranormal", "gothic", "occult", "esoteric"]),
    ("literature", 1, ["author", "reading", "poetry", "bookstore", "novel", "book club"]),
    ("diy electronics", 2, ["maker", "hackerspace", "electronics", "soldering", "hardware"]),
    ("soul and jazz", 2, ["soul", "jazz", "gospel", "tribute", "reissue", "r b"]),
    ("software", 2, ["scala", "rust", "swift", "ios", "ai", "agentic", "functional programming", "embedded systems"]),
    ("coffee", 3, ["coffee", "espresso"]),
    ("local cuisine", 3, ["restaurant", "food", "popup", "trucks"]),
    ("fruits and pastries", 3, ["farmers", "bakery", "pastry", "fruit"]),
    ("whiskey and bourbon", 3, ["whiskey", "bourbon", "distillery"]),
    ("bees", 3, ["bees", "beekeeping", "ecology"]),
    ("independent art", 3, ["gallery", "zine", "printmaking"]),
]

# Words in the longest phrase of the interests.
PHRASE_WORDS = 2

# Words that vote for a category.
CATEGORY_TERMS = [
    ("🎵 Music & Concerts", ["band", "concert", "dj", "jazz", "orchestra", "punk", "singer", "songs"]),
    ("🎬 Film & Cinema", ["cinema", "documentary", "film", "movie", "screening", "shorts"]),
    ("📚 Literary", ["author", "book", "novel", "poetry", "reading", "zine"]),
    ("🤝 Community & Politics", ["community", "labor", "meeting", "organizing", "solidarity", "union"]),
    ("🎨 Arts & Workshops", ["art", "class", "drawing", "exhibition", "gallery", "workshop"]),
    ("💻 Tech & Maker", ["coding", "electronics", "hackerspace", "maker", "programming", "software"]),
    ("🌿 Markets & Outdoors", ["farmers", "garden", "hike", "market", "outdoor", "park"]),
    ("👻 Horror & Occult", ["ghost", "gothic", "horror", "occult", "paranormal", "tarot"]),
    ("🎪 Festivals & Major Events", ["carnival", "fair", "festival", "parade"]),
]

# Holiday word and the month it belongs to.
HOLIDAY_MONTHS = [
    ("valentine", 2),
    ("juneteenth", 6),
    ("halloween", 10),
    ("thanksgiving", 11),
    ("christmas", 12),
]

# A film of a rendered showtime page: title, rating and running time on lines of their own.
FILM_HEAD = r"([^\n]+)\n\nRated:\n"
FILM_BLOCK = rf"\A{FILM_HEAD}([^\n]*)\nRuntime:\n([^\n]+)\n\n"
