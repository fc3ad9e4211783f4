"""FIXED VALUES. Results depend on these exact words, tables, patterns and limits."""

ORDER_ID_PATTERN = r"^[A-Z]{3}-\d{4}-\d{3}$"
EMAIL_PATTERN = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"

REQUIRED_FIELDS = ["order_id", "customer_name", "product", "quantity", "price", "order_date"]
OPTIONAL_FIELDS = ["source", "store_location", "customer_email", "product_category", "discount", "notes"]

# product spelling (lower case) -> catalogue name
PRODUCT_ALIASES = {
    "iphone 15": "iPhone 15",
    "iphone15": "iPhone 15",
    "iphone-15": "iPhone 15",
    "apple iphone 15": "iPhone 15",
    "macbook pro": "MacBook Pro",
    "macbookpro": "MacBook Pro",
    "macbook-pro": "MacBook Pro",
    "apple macbook pro": "MacBook Pro",
    "airpods pro": "AirPods Pro",
    "airpodspro": "AirPods Pro",
    "air pods pro": "AirPods Pro",
    "apple airpods pro": "AirPods Pro",
    "ipad air": "iPad Air",
    "ipadair": "iPad Air",
    "ipad-air": "iPad Air",
    "apple ipad air": "iPad Air",
    "apple watch": "Apple Watch",
    "applewatch": "Apple Watch",
    "apple-watch": "Apple Watch",
    "samsung galaxy s24": "Samsung Galaxy S24",
    "galaxy s24": "Samsung Galaxy S24",
    "galaxys24": "Samsung Galaxy S24",
    "s24": "Samsung Galaxy S24",
    "nintendo switch": "Nintendo Switch",
    "nintendoswitch": "Nintendo Switch",
    "switch": "Nintendo Switch",
    "playstation 5": "PlayStation 5",
    "playstation5": "PlayStation 5",
    "ps5": "PlayStation 5",
    "xbox series x": "Xbox Series X",
    "xboxseriesx": "Xbox Series X",
    "xbox x": "Xbox Series X",
    "kindle paperwhite": "Kindle Paperwhite",
    "kindlepaperwhite": "Kindle Paperwhite",
    "kindle": "Kindle Paperwhite",
}

# the shorter list of the compact transform
PRODUCT_ALIASES_SHORT = {
    "iphone 15": "iPhone 15",
    "macbook pro": "MacBook Pro",
    "airpods pro": "AirPods Pro",
    "ipad air": "iPad Air",
    "apple watch": "Apple Watch",
    "nintendo switch": "Nintendo Switch",
    "playstation 5": "PlayStation 5",
    "xbox series x": "Xbox Series X",
}

LOCATION_ALIASES = {
    "ny": "New York",
    "nyc": "New York",
    "new york city": "New York",
    "la": "Los Angeles",
    "los angeles ca": "Los Angeles",
    "chicago il": "Chicago",
    "houston tx": "Houston",
    "phoenix az": "Phoenix",
    "philadelphia pa": "Philadelphia",
    "san antonio tx": "San Antonio",
    "san diego ca": "San Diego",
    "dallas tx": "Dallas",
    "san jose ca": "San Jose",
}

SOURCE_ALIASES_CLEAN = {
    "web": "website",
    "online": "website",
    "app": "mobile_app",
    "mobile": "mobile_app",
    "retail": "store",
    "shop": "store",
    "call": "phone",
    "telephone": "phone",
}
VALID_SOURCES = ["website", "mobile_app", "store", "phone", "partner", "unknown"]

SOURCE_ALIASES_STANDARD = {
    "web": "website",
    "online": "website",
    "internet": "website",
    "app": "mobile_app",
    "mobile": "mobile_app",
    "phone": "phone",
    "call": "phone",
    "telephone": "phone",
    "retail": "store",
    "shop": "store",
    "physical": "store",
    "partner": "partner",
    "affiliate": "partner",
}

CATEGORY_ALIASES_CLEAN = {
    "electronic": "Electronics",
    "electronics": "Electronics",
    "tech": "Electronics",
    "technology": "Electronics",
    "gaming": "Gaming",
    "games": "Gaming",
    "game": "Gaming",
    "book": "Books",
    "books": "Books",
    "reading": "Books",
    "smart home": "Smart Home",
    "smarthome": "Smart Home",
    "home": "Smart Home",
    "fitness": "Fitness",
    "health": "Fitness",
    "sport": "Fitness",
}

CATEGORY_ALIASES_STANDARD = {
    "electronic": "electronics",
    "tech": "electronics",
    "technology": "electronics",
    "game": "gaming",
    "games": "gaming",
    "book": "books",
    "reading": "books",
    "home": "smart_home",
    "smart home": "smart_home",
    "fitness": "health_fitness",
    "health": "health_fitness",
    "sport": "health_fitness",
}

SEGMENT_ALIASES = {
    "vip": "VIP",
    "premium": "Premium",
    "standard": "Standard",
    "regular": "Standard",
    "budget": "Budget",
    "basic": "Budget",
}

SOURCE_CATEGORIES = {"store": "Physical", "website": "Online", "mobile": "Online"}

CHANNEL_TYPES = {
    "website": "Digital",
    "mobile_app": "Digital",
    "store": "Physical",
    "phone": "Traditional",
    "partner": "Channel",
    "unknown": "Other",
}

EMAIL_DOMAIN_ALIASES = {
    "googlemail.com": "gmail.com",
    "ymail.com": "yahoo.com",
    "hotmail.com": "outlook.com",
    "live.com": "outlook.com",
    "msn.com": "outlook.com",
}
PERSONAL_DOMAINS = ["gmail.com", "yahoo.com", "hotmail.com", "outlook.com"]

ADDRESS_WORDS = {
    "st": "Street", "street": "Street", "ave": "Avenue", "avenue": "Avenue",
    "blvd": "Boulevard", "boulevard": "Boulevard", "rd": "Road", "road": "Road",
    "dr": "Drive", "drive": "Drive", "ln": "Lane", "lane": "Lane",
    "ct": "Court", "court": "Court", "pl": "Place", "place": "Place",
    "n": "North", "north": "North", "s": "South", "south": "South",
    "e": "East", "east": "East", "w": "West", "west": "West",
    "ne": "Northeast", "nw": "Northwest", "se": "Southeast", "sw": "Southwest",
    "ca": "California", "ny": "New York", "tx": "Texas", "fl": "Florida", "il": "Illinois",
    "pa": "Pennsylvania", "oh": "Ohio", "ga": "Georgia", "nc": "North Carolina", "mi": "Michigan",
}

CURRENCY_SYMBOLS = "$€£¥₹₽₩¢"

BRAND_CASE = {
    "Iphone": "iPhone",
    "Ipad": "iPad",
    "Macbook": "MacBook",
    "Airpods": "AirPods",
    "Playstation": "PlayStation",
    "Xbox": "Xbox",
}

# product name -> (brand, subcategory, price tier, popularity); a later match overrides an earlier one
PRODUCT_CATALOG = {
    "iPhone 15": ("Apple", "Smartphones", "Premium", 95),
    "MacBook Pro": ("Apple", "Laptops", "Premium", 90),
    "AirPods Pro": ("Apple", "Audio", "Premium", 88),
    "iPad Air": ("Apple", "Tablets", "Premium", 85),
    "Apple Watch": ("Apple", "Wearables", "Premium", 82),
    "Samsung Galaxy S24": ("Samsung", "Smartphones", "Premium", 80),
    "Nintendo Switch": ("Nintendo", "Consoles", "Mid-range", 85),
    "PlayStation 5": ("Sony", "Consoles", "Premium", 92),
    "Xbox Series X": ("Microsoft", "Consoles", "Premium", 88),
    "Kindle Paperwhite": ("Amazon", "E-readers", "Budget", 75),
}

# product words -> category; the first match wins
PRODUCT_CATEGORY_KEYS = {
    "iPhone": "Smartphones",
    "MacBook": "Laptops",
    "iPad": "Tablets",
    "AirPods": "Audio",
    "Apple Watch": "Wearables",
    "Nintendo Switch": "Gaming",
    "Samsung Galaxy": "Smartphones",
    "Sony": "Audio",
}

# exact product name -> (brand, release year, average rating)
PRODUCT_FACTS = {
    "iPhone 15": ("Apple", 2023, 4.5),
    "MacBook Pro": ("Apple", 2023, 4.7),
    "iPad Air": ("Apple", 2022, 4.4),
    "AirPods Pro": ("Apple", 2022, 4.6),
    "Apple Watch Series 9": ("Apple", 2023, 4.3),
    "Nintendo Switch Oled": ("Nintendo", 2021, 4.8),
    "Samsung Galaxy S24": ("Samsung", 2024, 4.4),
    "Sony Wh-1000Xm5": ("Sony", 2022, 4.7),
}

# title keywords -> product, in order; the fallback list is picked from by hash
TITLE_PRODUCTS = [
    (["phone", "mobile", "call"], "iPhone 15"),
    (["computer", "laptop", "tech"], "MacBook Pro"),
    (["music", "audio", "sound"], "AirPods Pro"),
    (["watch", "time"], "Apple Watch"),
    (["tablet", "pad"], "iPad Air"),
    (["game", "play"], "Nintendo Switch"),
    (["book", "read"], "Kindle Paperwhite"),
]
TITLE_FALLBACK = ["iPhone 15", "MacBook Pro", "AirPods Pro", "iPad Air", "Apple Watch"]

# segment -> (minimum spent, minimum orders, discount rate, priority), best first
CUSTOMER_SEGMENTS = {
    "VIP": (5000, 10, 0.15, 1),
    "Premium": (2000, 5, 0.10, 2),
    "Standard": (500, 2, 0.05, 3),
    "Budget": (0, 0, 0.02, 4),
}

SEASONAL_FACTORS = {
    1: 0.85, 2: 0.90, 3: 0.95, 4: 1.00, 5: 1.05, 6: 1.10,
    7: 1.15, 8: 1.10, 9: 1.05, 10: 1.20, 11: 1.40, 12: 1.50,
}
SEASONAL_FACTORS_SIMPLE = {
    1: 0.8, 2: 0.9, 3: 1.0, 4: 1.0, 5: 1.1, 6: 1.0,
    7: 1.0, 8: 1.1, 9: 1.2, 10: 1.1, 11: 1.4, 12: 1.5,
}
SEASONS = {
    12: "Winter", 1: "Winter", 2: "Winter", 3: "Spring", 4: "Spring", 5: "Spring",
    6: "Summer", 7: "Summer", 8: "Summer", 9: "Fall", 10: "Fall", 11: "Fall",
}

TEST_NAME_WORDS = ["test", "dummy", "sample", "example"]
TEST_NAME_WORDS_STRICT = ["test", "dummy", "sample", "example", "null", "none"]

ORDER_STATUSES = ["pending", "processing", "shipped", "delivered", "cancelled"]

# score -> level, best first
QUALITY_LEVELS = [(95, "excellent"), (85, "good"), (70, "fair"), (50, "poor"), (None, "critical")]
QUALITY_GRADES = [(95, "A"), (85, "B"), (70, "C"), (50, "D"), (None, "F")]

SEVERITY_LEVELS = {"LOW": 1, "MEDIUM": 2, "HIGH": 3, "CRITICAL": 4}
SEVERITY_PENALTY = {"critical": 10, "high": 5, "medium": 2, "low": 1}

# date formats with the shape of their text; no two share a shape
DATE_FORMATS = {
    "yyyy-M-d": r"^\d{4}-\d{1,2}-\d{1,2}$",
    "M/d/yyyy": r"^\d{1,2}/\d{1,2}/\d{4}$",
    "d-M-yyyy": r"^\d{1,2}-\d{1,2}-\d{4}$",
    "yyyy/M/d": r"^\d{4}/\d{1,2}/\d{1,2}$",
    "d MMM yyyy": r"^\d{1,2} [A-Za-z]{3} \d{4}$",
    "d/M/yy": r"^\d{1,2}/\d{1,2}/\d{2}$",
}

# fields of a landed order table extract
ORDER_EXTRACT_COLUMNS = [
    "order_id", "customer_name", "customer_email", "product", "product_category", "quantity", "price",
    "discount", "total_amount", "order_date", "store_location", "source", "created_at", "updated_at",
]
CUSTOMER_EXTRACT_COLUMNS = [
    "customer_id", "customer_name", "email", "phone", "address", "city", "state", "country", "postal_code",
    "registration_date", "last_order_date", "total_orders", "total_spent", "customer_segment",
    "created_at", "updated_at",
]
