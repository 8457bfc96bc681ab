"""Fixed lookup content of our own: user-agent strings and parse rules.

The rule files of the reference are not part of it, so this is an invented,
small rule set in the same shape (kind, priority, regex, replacements).
Replacements may reference capture groups as ``$1`` .. ``$9``.
Regexes stay inside the subset shared by Java and RE2 (no look-around,
no back-references) so the same rules run in Spark and in DuckDB oracles.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# User agents of the test-data adapter, index 0..9.
USER_AGENTS = [
    "Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/120.0.6099.109 Safari/537.36",
    "Mozilla/5.0 (Macintosh; Intel Mac OS X 10_15_7) AppleWebKit/605.1.15 (KHTML, like Gecko) Version/17.1 Safari/605.1.15",
    "Mozilla/5.0 (X11; Linux x86_64; rv:121.0) Gecko/20100101 Firefox/121.0",
    "Mozilla/5.0 (iPhone; CPU iPhone OS 17_1_2 like Mac OS X) AppleWebKit/605.1.15 (KHTML, like Gecko) Version/17.1 Mobile/15E148 Safari/604.1",
    "Mozilla/5.0 (Linux; Android 14; Pixel 8) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/120.0.6099.43 Mobile Safari/537.36",
    "Mozilla/5.0 (Linux; Android 13; SM-S918B) AppleWebKit/537.36 (KHTML, like Gecko) SamsungBrowser/23.0 Chrome/115.0.0.0 Mobile Safari/537.36",
    "Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/120.0.0.0 Safari/537.36 Edg/120.0.2210.77",
    "Mozilla/5.0 (iPad; CPU OS 16_6 like Mac OS X) AppleWebKit/605.1.15 (KHTML, like Gecko) CriOS/119.0.6045.169 Mobile/15E148 Safari/604.1",
    "curl/8.4.0",
    "Mozilla/5.0 (compatible; ExampleBot/2.1; +http://bot.example.org/)",
]

# Parse rules (kind, priority, regex, replacements).
# Lower priority number wins when several rules match.
UA_RULES = [
    ("browser", 10, r"Edg/(\d+)\.(\d+)", {"family": "Edge", "v1": "$1", "v2": "$2"}),
    ("browser", 20, r"SamsungBrowser/(\d+)\.(\d+)", {"family": "Samsung Internet", "v1": "$1", "v2": "$2"}),
    ("browser", 30, r"CriOS/(\d+)\.(\d+)", {"family": "Chrome Mobile iOS", "v1": "$1", "v2": "$2"}),
    ("browser", 40, r"Chrome/(\d+)\.(\d+).*Mobile", {"family": "Chrome Mobile", "v1": "$1", "v2": "$2"}),
    ("browser", 50, r"Chrome/(\d+)\.(\d+)", {"family": "Chrome", "v1": "$1", "v2": "$2"}),
    ("browser", 60, r"Firefox/(\d+)\.(\d+)", {"family": "Firefox", "v1": "$1", "v2": "$2"}),
    ("browser", 70, r"Version/(\d+)\.(\d+).*Mobile.*Safari", {"family": "Mobile Safari", "v1": "$1", "v2": "$2"}),
    ("browser", 80, r"Version/(\d+)\.(\d+).*Safari", {"family": "Safari", "v1": "$1", "v2": "$2"}),
    ("browser", 90, r"^(curl)/(\d+)\.(\d+)", {"family": "$1", "v1": "$2", "v2": "$3"}),
    ("os", 10, r"Windows NT 10\.0", {"os": "Windows", "v1": "10"}),
    ("os", 20, r"iPhone OS (\d+)_(\d+)(?:_(\d+))?", {"os": "iOS", "v1": "$1", "v2": "$2", "v3": "$3"}),
    ("os", 30, r"CPU OS (\d+)_(\d+)(?:_(\d+))?", {"os": "iPadOS", "v1": "$1", "v2": "$2", "v3": "$3"}),
    ("os", 40, r"Mac OS X (\d+)_(\d+)(?:_(\d+))?", {"os": "Mac OS X", "v1": "$1", "v2": "$2", "v3": "$3"}),
    ("os", 50, r"Android (\d+)(?:\.(\d+))?", {"os": "Android", "v1": "$1", "v2": "$2"}),
    ("os", 60, r"Linux", {"os": "Linux"}),
    ("device", 10, r"iPhone", {"brand": "Apple", "device": "iPhone"}),
    ("device", 20, r"iPad", {"brand": "Apple", "device": "iPad"}),
    ("device", 30, r"Pixel (\d+)", {"brand": "Google", "device": "Pixel $1"}),
    ("device", 40, r"SM-([A-Z0-9]+)", {"brand": "Samsung", "device": "SM-$1"}),
    ("device", 50, r"Macintosh", {"brand": "Apple", "device": "Mac"}),
    ("device", 60, r"(?i)bot|crawler|spider", {"device": "Spider"}),
]
# ---------------------------------------------------------------------------
