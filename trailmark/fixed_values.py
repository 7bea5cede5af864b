"""Codes, patterns and literals the reports are defined by."""

# Brand code -> custom-dimension indexes holding the member id, first present wins.
BRAND_ID_KEYS = {
    "01": (178,),
    "07": (178,),
    "15": (10,),
    "16": (182, 178),
    "40": (10,),
    "45": (178,),
    "51": (178,),
}

# Ads account name prefix (a LIKE pattern, "_" is any one character) -> brand code.
ACCOUNT_PREFIXES = (
    ("lpd_tw_lan", "01"),
    ("lpd_tw_bio", "07"),
    ("lpd_tw_hr", "15"),
    ("lpd_tw_gio", "16"),
    ("lpd_tw_shu", "40"),
    ("lpd_tw_k", "45"),
    ("lpd_tw_ysl", "51"),
)

# Traffic medium -> medium group.
MEDIUM_GROUPS = (
    ("referral", "Referral"),
    ("organic", "Organic"),
    ("cpc", "Paid Media"),
    ("paid_search", "Paid Media"),
    ("dirbuy_display", "Paid Media"),
    ("dirbuy_native", "Paid Media"),
    ("prog_native", "Paid Media"),
    ("prog_display", "Paid Media"),
    ("prog_deal", "Paid Media"),
    ("retarg_display", "Paid Media"),
    ("website_partnership", "Paid Media"),
    ("dirbuy_video", "Paid Media"),
    ("prog_video", "Paid Media"),
    ("social_post_paid", "Paid Media"),
    ("social_video_paid", "Paid Media"),
    ("social_influencer", "Paid Media"),
    ("website_influencer", "Paid Media"),
    ("email_dbrenting", "Paid Media"),
    ("all_affiliate", "Paid Media"),
    ("cse_feed", "Paid Media"),
    ("cse_display", "Paid Media"),
    ("msg", "Paid Media"),
    ("qrcode", "Paid Media"),
    ("influencer_orga", "Earned Media"),
    ("freeimpr", "Earned Media"),
    ("peimpr", "Earned Media"),
    ("social_video_orga", "Owned Media"),
    ("social_post_orga", "Owned Media"),
    ("crmmsg", "Owned Media"),
    ("ownqrcode", "Owned Media"),
    ("eba_ec", "Owned Media"),
    ("email_brand", "Owned Media"),
    ("email_trigger", "Owned Media"),
    ("email_loyalty", "Owned Media"),
)
UNMAPPED_MEDIUM = "others"

# Journey pivot: output prefix -> channel.
JOURNEY_CHANNELS = {
    "channel_affiliation": "Affiliation",
    "channel_direct": "Direct",
    "channel_display": "Display",
    "channel_email": "Email",
    "channel_organic_search": "Organic Search",
    "channel_paid_search": "Paid Search",
    "channel_referral": "Referral",
    "channel_social_influencer": "Social & Influencer",
    "channel_others": "(Other)",
}

# Journey pivot: output prefix -> medium group.
JOURNEY_MEDIUMS = {
    "medium_organic": "Organic",
    "medium_owned_media": "Owned Media",
    "medium_paid_media": "Paid Media",
    "medium_referral": "Referral",
    "medium_others": "others",
}

# Journey pivot: output prefix -> (event category, event action), compared exactly.
JOURNEY_EVENTS = {
    "event_product_detail": ("Ecommerce", "Product Detail"),
    "event_product_impression": ("Ecommerce", "Product Impressions"),
    "event_promotion_impression": ("Ecommerce", "Promotion Impressions"),
    "event_product_click": ("Ecommerce", "Product Click"),
    "event_promotion_click": ("Ecommerce", "Promotion Click"),
    "event_add_to_cart": ("Ecommerce", "Add to Cart"),
    "event_add_to_favorite": ("ecommerce", "add to favorites"),
    "event_checkout": ("Ecommerce", "Checkout"),
    "event_purchase": ("Ecommerce", "Purchase"),
    "event_video_play": ("Video", "Play"),
    "event_find_store": ("store locator", "find a store"),
    "event_internal_search": ("internal search", "display"),
}

# Journey pivot: output prefix -> (text inside the event category, ignore case).
JOURNEY_CATEGORY_TEXTS = {
    "event_virtual_try_on": ("virtual try on", False),
    "event_analysis_skindr": ("analysis::skindr", False),
    "event_shade_finder": ("shade-finder", True),
}

# Ads slots counted as "top" and as "search" in the top-impression ratio.
TOP_SLOT = "SearchTop"
SEARCH_SLOTS = ("SearchOther", "SearchTop")
HISTORY_ENDS = "2022-01-01"

# Search-interest horizons: output -> (days back, weight in the score).
TREND_HORIZONS = {
    "slope_3m": (90, 2),
    "slope_6m": (180, 2),
    "slope_1y": (365, 1),
}

# Beacon data checks.
BEACON_EVENT_TYPES = ("enter", "push", "banner")
BEACON_BRANDS = ("01", "07", "15", "16", "40", "45", "51")
BEACON_UID_LENGTH = 33

# Civil time of the reports.
LOCAL_OFFSET_HOURS = 8
