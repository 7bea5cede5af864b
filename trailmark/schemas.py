"""Input schemas. All columns are nullable."""

from pyspark.sql import DataFrame
from pyspark.sql import types as T

BIGINT, DOUBLE, STRING = T.LongType(), T.DoubleType(), T.StringType()
BOOLEAN, DATE, INSTANT = T.BooleanType(), T.DateType(), T.TimestampType()


def record(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


def texts(names: str) -> T.StructType:
    """A struct of string fields."""
    return record(**{name: STRING for name in names.split()})


def require(frame: DataFrame, columns: T.StructType) -> DataFrame:
    """The frame itself, all its columns, if it has the given ones with their types."""
    have = {f.name: f.dataType for f in frame.schema.fields}
    wrong = [f"{f.name} {f.dataType.simpleString()}" for f in columns.fields if have.get(f.name) != f.dataType]
    if wrong:
        raise ValueError(f"columns are missing or have another type: {', '.join(wrong)}")
    return frame


HIT = record(
    type=STRING,
    hitNumber=BIGINT,
    time=BIGINT,
    isInteraction=BOOLEAN,
    isEntrance=BOOLEAN,
    isExit=BOOLEAN,
    referer=STRING,
    page=texts("pagePath pageTitle"),
    product=T.ArrayType(texts("productSKU v2ProductName")),
    contentGroup=texts("contentGroup1"),
    eventInfo=texts("eventCategory eventAction eventLabel"),
    experiment=T.ArrayType(texts("experimentId experimentVariant")),
    customDimensions=T.ArrayType(record(index=BIGINT, value=STRING)),
)

SESSIONS = record(
    date=STRING,
    fullVisitorId=STRING,
    visitId=BIGINT,
    visitNumber=BIGINT,
    channelGrouping=STRING,
    visitStartTime=BIGINT,
    totals=record(
        visits=BIGINT,
        hits=BIGINT,
        pageviews=BIGINT,
        timeOnSite=BIGINT,
        transactions=BIGINT,
        totalTransactionRevenue=BIGINT,
        bounces=BIGINT,
    ),
    trafficSource=texts("referralPath campaign source medium keyword adContent"),
    device=record(
        browser=STRING,
        operatingSystem=STRING,
        isMobile=BOOLEAN,
        mobileDeviceBranding=STRING,
        mobileDeviceModel=STRING,
        mobileDeviceInfo=STRING,
        deviceCategory=STRING,
    ),
    geoNetwork=texts("continent subContinent country region metro city"),
    hits=T.ArrayType(HIT),
)

# Columns the ads reports use. The tables have more, and their distinct unions compare all of
# them, so they are read without a stated schema and checked with ``require``.
ADS_CAMPAIGN = record(
    CampaignId=BIGINT, CampaignName=STRING, AdvertisingChannelType=STRING, _PARTITIONTIME=INSTANT
)
ADS_CUSTOMER = record(
    ExternalCustomerId=BIGINT,
    AccountDescriptiveName=STRING,
    AccountCurrencyCode=STRING,
    _PARTITIONTIME=INSTANT,
)
ADS_CAMPAIGN_STATS = record(Date=DATE, CampaignId=BIGINT, CurrentModelAttributedConversions=DOUBLE)
ADS_BASIC_STATS = record(
    Date=DATE,
    ExternalCustomerId=BIGINT,
    CampaignId=BIGINT,
    Clicks=BIGINT,
    Impressions=BIGINT,
    Cost=BIGINT,
    Slot=STRING,
    ViewThroughConversions=BIGINT,
    Conversions=DOUBLE,
)
ADS_COOKIE_STATS = record(Date=DATE, CampaignId=BIGINT, AbsoluteTopImpressionPercentage=STRING)
ADS_HISTORY = record(
    Account=STRING,
    Date=DATE,
    Campaign_name=STRING,
    Advertising_channel_type=STRING,
    Currency_code=STRING,
    Clicks=BIGINT,
    impressions=BIGINT,
    CTR=DOUBLE,
    CPC=DOUBLE,
    Cost=DOUBLE,
    Absolute_top_impression_percentage=DOUBLE,
    Top_impression_percentage=DOUBLE,
    Conversions=BIGINT,
    View_through_conversions=BIGINT,
    Cost_per_conversion=DOUBLE,
    Conversion_rate=DOUBLE,
)
INTEREST = record(date=DATE, hits=BIGINT, keyword=STRING, is_luxe=BOOLEAN, updated_datetime=INSTANT)
KEYWORDS = record(keyword=STRING, is_luxe=BOOLEAN)
BEACON = record(
    event_name=STRING,
    event_start_at=DATE,
    event_end_at=DATE,
    receiver_uid=STRING,
    event_type=STRING,
    event_time=INSTANT,
    first_follow=INSTANT,
    bind_date=STRING,
    brand_id=STRING,
)
MEDIUM_LOOKUP = texts("utm_medium mapping_type")
BRAND_SALES = record(brand=STRING, sales=DOUBLE)
