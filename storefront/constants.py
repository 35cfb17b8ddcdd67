"""Fixed values of the analyses.

These are parameters of the questions (prices, point rates, labels, dates),
stated once here. Where a question names a value that does not exist in the
test tables (a product called 'sushi', customers 'A'/'B', the years
2018-2020), the stand-in chosen for the test tables is given next to it.
"""

from datetime import date

# ---- fixed values: loyalty points -------------------------------------
POINTS_PER_UNIT = 10            # 10 points per currency unit spent
POINTS_FLAT_NAMED = 20          # flat points per named item (literal form)
POINTS_FLAT_OTHER = 10          # flat points per other item (literal form)
NAMED_ITEM_MULTIPLIER = 2       # named item earns double
JOIN_WEEK_MULTIPLIER = 2        # first 7 days after joining earn double
JOIN_WEEK_DAYS = 7
NAMED_ITEM = "red plate"        # stand-in for 'sushi' (a p_name of the part table)
POINTS_CUTOFF = date(1998, 12, 31)   # stand-in for the end of January
MEMBER_PRIORITY = "1-URGENT"    # first order with this priority = membership start

# ---- fixed values: fulfilment ------------------------------------------
PRODUCT_A = "ECONOMY"           # stand-in for 'Meatlovers' (a p_type)
PRODUCT_B = "LARGE"             # stand-in for 'Vegetarian' (a p_type)
PRICE_A = 12
PRICE_B = 10
PRICE_OTHER = 0
EXTRA_CHARGE = 1
COST_PER_KM = "0.30"            # runner pay per kilometre (exact decimal)
NEW_PRODUCT_NAME = "Supreme"
LIST_SEPARATOR = ", "           # separator the literal statements split on
LIST_SEPARATOR_PATTERN = r",\s*"  # separator as written in the data
MISSING_TOKENS = ("", "null")   # text tokens that mean 'no value'
CANCELLED_TEXT = "Restaurant Cancellation"
SIGNUP_ANCHOR = date(1995, 1, 1)  # stand-in for the 2021-01-01 week anchor
BULK_QUANTITY = 50              # items of one product that make a purchase a bulk purchase
RATING_MIN = 1
RATING_MAX = 5
RATINGS_LOADED_AT = "2002-01-01 00:00:00"  # DEFAULT value of rating_time for this load

# ---- fixed values: weekly sales mart -----------------------------------
YEAR_LABELS = ("1996", "1997", "1998")   # stand-ins for 2018, 2019, 2020
BASELINE = date(1998, 6, 15)             # stand-in for 2020-06-15 (a Monday, ISO week 25)
AGE_BANDS = (("1", "Young Adults"), ("2", "Middle Aged"), ("3", "Retirees"), ("4", "Retirees"))
DEMOGRAPHICS = (("C", "Couples"), ("F", "Families"))
UNKNOWN = "Unknown"
PLATFORM_RETAIL = "Retail"
PLATFORM_SHOPIFY = "Shopify"
TWO_DIGIT_YEAR_PIVOT = 2070     # 'yy' years parsed at or after this belong to the 1900s
WEEKS_SHORT = 4
WEEKS_LONG = 12
MAX_WEEK = 53
