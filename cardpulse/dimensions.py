"""Dimension tables.

Every table here has a fixed, small row count (at most 24 rows), so each is
built on the driver once and is safe to broadcast: its size does not grow
with the fact data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# FIXED VALUES — must equal the transaction model's published constants.
# ---------------------------------------------------------------------------

# category: merchants, amount range (INR), online probability
MERCHANT_CATEGORIES = [
    ("groceries", ["BigBasket", "DMart", "More Supermarket", "Reliance Fresh", "Star Bazaar", "Nature's Basket", "Spencer's"], 150, 8000, 0.35),
    ("online_retail", ["Amazon", "Flipkart", "Myntra", "Meesho", "Ajio", "Tata Cliq", "Nykaa"], 200, 50000, 0.95),
    ("electronics", ["Croma", "Reliance Digital", "Vijay Sales", "Samsung Store", "Apple Store"], 1000, 150000, 0.45),
    ("fuel", ["IndianOil", "HP Fuel", "Bharat Petroleum", "Shell", "Nayara Energy"], 200, 5000, 0.0),
    ("dining", ["Swiggy", "Zomato", "Barbeque Nation", "Haldiram's", "Domino's", "McDonald's", "Starbucks", "Chai Point"], 100, 5000, 0.65),
    ("travel", ["MakeMyTrip", "Cleartrip", "IRCTC", "IndiGo", "Air India", "RedBus", "Ola", "Uber"], 100, 80000, 0.85),
    ("entertainment", ["BookMyShow", "Netflix", "Spotify", "Hotstar", "Amazon Prime", "Jio Cinema"], 99, 2000, 0.90),
    ("healthcare", ["Apollo Pharmacy", "Practo", "1mg", "PharmEasy", "Netmeds", "MedPlus"], 100, 25000, 0.50),
    ("utilities", ["BESCOM", "Tata Power", "Jio", "Airtel", "Vi", "Mahanagar Gas", "BSNL"], 200, 5000, 0.80),
    ("fashion", ["Zara", "H&M", "Shoppers Stop", "Lifestyle", "Pantaloons", "Max Fashion", "FabIndia"], 500, 30000, 0.55),
]

# city: lat, lon, weight
CITIES = [
    ("Bangalore", 12.9716, 77.5946, 0.20),
    ("Mumbai", 19.0760, 72.8777, 0.18),
    ("Delhi", 28.7041, 77.1025, 0.15),
    ("Hyderabad", 17.3850, 78.4867, 0.10),
    ("Chennai", 13.0827, 80.2707, 0.08),
    ("Pune", 18.5204, 73.8567, 0.07),
    ("Kolkata", 22.5726, 88.3639, 0.06),
    ("Ahmedabad", 23.0225, 72.5714, 0.05),
    ("Jaipur", 26.9124, 75.7873, 0.04),
    ("Lucknow", 26.8467, 80.9462, 0.03),
    ("Chandigarh", 30.7333, 76.7794, 0.02),
    ("Kochi", 9.9312, 76.2673, 0.02),
]

# fraud type: weight
FRAUD_TYPES = [
    ("card_not_present", 0.30),
    ("account_takeover", 0.25),
    ("geographic_anomaly", 0.20),
    ("velocity_abuse", 0.15),
    ("friendly_fraud", 0.10),
]

# complexity level: weight, confidence low, confidence high
COMPLEXITY = [
    ("easy", 0.30, 0.70, 0.95),
    ("medium", 0.45, 0.40, 0.70),
    ("hard", 0.25, 0.15, 0.40),
]

# profile: weight, income lo/hi, limit lo/hi, card types, spend factor lo/hi,
#          preferred categories, emi lo/hi, default probability
PROFILES = [
    ("high_income", 0.136, 150000, 500000, 300000, 1000000, ["credit"], 0.15, 0.35,
     ["online_retail", "electronics", "travel", "fashion", "dining"], 0, 3, 0.02),
    ("mid_income", 0.475, 40000, 150000, 75000, 300000, ["credit", "debit"], 0.20, 0.45,
     ["groceries", "online_retail", "dining", "utilities", "fuel"], 0, 5, 0.08),
    ("low_income", 0.291, 15000, 40000, 25000, 75000, ["debit"], 0.30, 0.60,
     ["groceries", "fuel", "utilities", "healthcare"], 0, 3, 0.15),
    ("student", 0.098, 5000, 15000, 10000, 30000, ["debit"], 0.40, 0.70,
     ["dining", "entertainment", "online_retail", "fashion"], 0, 1, 0.10),
]

# device type: allowed channels
DEVICE_CHANNELS = [
    ("mobile", ["app", "mobile_wallet"]),
    ("desktop", ["web"]),
    ("pos_terminal", ["in_store"]),
    ("tablet", ["app", "web"]),
]

# hour of day (local): traffic multiplier; the 24 values sum to 13.74
HOURLY_MULTIPLIERS = [
    0.08, 0.05, 0.03, 0.03, 0.05, 0.10, 0.25, 0.45, 0.65, 0.80, 0.90, 0.95,
    1.00, 0.95, 0.85, 0.80, 0.75, 0.85, 0.95, 1.00, 0.90, 0.70, 0.45, 0.20,
]

# burst: chance per hour, rate multiplier lo/hi, duration minutes lo/hi
BURST = (0.03, 8.0, 10.0, 10, 30)

FRAUD_RATE = 0.04
TARGET_DAILY_TRANSACTIONS = 24000

# ---------------------------------------------------------------------------
# Adapter dimensions (our design): the driver's ``events`` table has five
# event types and 25 nation keys; these map them onto the vocabulary above so
# the category / city / profile operators have something to join against.
# ---------------------------------------------------------------------------

# event_type -> transaction-model category
EVENT_CATEGORY = [
    ("purchase", "online_retail"),
    ("view", "entertainment"),
    ("click", "dining"),
    ("signup", "utilities"),
    ("error", "electronics"),
]

# market segment -> preferred event types (the card's habitual categories)
SEGMENT_PREFERRED = [
    ("AUTOMOBILE", ["purchase", "click"]),
    ("BUILDING", ["view", "signup"]),
    ("FURNITURE", ["purchase", "view"]),
    ("HOUSEHOLD", ["click", "error"]),
    ("MACHINERY", ["signup", "error"]),
]

# income bands over account balance (stand-in for monthly income)
BALANCE_BANDS = [
    ("student", None, 0.0),
    ("low_income", 0.0, 3000.0),
    ("mid_income", 3000.0, 7500.0),
    ("high_income", 7500.0, None),
]


def merchant_category_df(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        MERCHANT_CATEGORIES,
        "category string, merchants array<string>, amount_min int, amount_max int, online_probability double")


def city_df(spark: SparkSession) -> DataFrame:
    rows = [(i, c, lat, lon, w) for i, (c, lat, lon, w) in enumerate(CITIES)]
    return spark.createDataFrame(rows, "city_id int, city string, city_lat double, city_lon double, weight double")


def fraud_type_df(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(FRAUD_TYPES, "fraud_type string, weight double")


def complexity_df(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(COMPLEXITY, "complexity string, weight double, conf_lo double, conf_hi double")


def profile_df(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        PROFILES,
        "profile string, weight double, income_lo int, income_hi int, limit_lo int, limit_hi int, "
        "card_types array<string>, spend_lo double, spend_hi double, preferred_categories array<string>, "
        "emi_lo int, emi_hi int, default_probability double")


def device_channel_df(spark: SparkSession) -> DataFrame:
    """Exploded (device_type, channel) allow-list: 6 rows."""
    return (spark.createDataFrame(DEVICE_CHANNELS, "device_type string, channels array<string>")
            .select("device_type", F.explode("channels").alias("channel")))


def hourly_rate_df(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(enumerate(HOURLY_MULTIPLIERS)), "hour int, multiplier double")


def event_category_df(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(EVENT_CATEGORY, "merchant_category string, model_category string")


def segment_preferred_df(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(SEGMENT_PREFERRED, "segment string, preferred array<string>")


def cumulative(rows, weight_index: int = 1):
    """(name, lo, hi) cumulative-weight intervals for a weighted pick."""
    out, acc = [], 0.0
    for row in rows:
        lo = acc
        acc = round(acc + row[weight_index], 10)
        out.append((row[0], lo, acc))
    return out
