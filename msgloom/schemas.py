"""Record schemas, as plain lists of names and types; no session is needed to load them."""

from __future__ import annotations

from pyspark.sql import types as T

from msgloom.config import SLOTS


_KINDS = {
    "STRING": T.StringType(),
    "INT": T.IntegerType(),
    "BIGINT": T.LongType(),
    "FLOAT": T.FloatType(),
    "BOOLEAN": T.BooleanType(),
    "DATE": T.DateType(),
    "TIMESTAMP": T.TimestampType(),
    "STRINGS": T.ArrayType(T.StringType()),
    "STRING_MAP": T.MapType(T.StringType(), T.StringType()),
    "COUNT_MAP": T.MapType(T.StringType(), T.LongType()),
}


def _struct(columns: str, **nested: T.DataType) -> T.StructType:
    """A struct from ``name TYPE`` pairs; nested types come by a name of their own."""
    kinds = {**_KINDS, **nested}
    pairs = (column.strip().rsplit(" ", 1) for column in columns.split(","))
    return T.StructType([T.StructField(name, kinds[kind]) for name, kind in pairs])


# --- fixed values: the notification record (114 fields) ----------------------------
_PLATFORM_STATS = _struct("""
    successful INT, failed INT, errored INT, converted INT, received INT, suppressed INT,
    frequency_capped INT, provider_successful INT, provider_failed INT, provider_errored INT
""")
_BUTTON = _struct("id STRING, text STRING, icon STRING, url STRING")
NOTIFICATION = _struct(
    """
    id STRING, app_id STRING, name STRING, canceled BOOLEAN,
    contents STRING_MAP, headings STRING_MAP, subtitle STRING,
    data STRING_MAP,
    queued_at BIGINT, send_after BIGINT, completed_at BIGINT,
    delivery_time_of_day STRING, delayed_option STRING,
    successful INT, failed INT, errored INT, converted INT, remaining INT, received INT,
    platform_delivery_stats PLATFORM_STATS,
    isAdm BOOLEAN, isAndroid BOOLEAN, isChrome BOOLEAN, isChromeWeb BOOLEAN, isAlexa BOOLEAN,
    isFirefox BOOLEAN, isIos BOOLEAN, isSafari BOOLEAN, isWP BOOLEAN, isWP_WNS BOOLEAN,
    isEdge BOOLEAN, isHuawei BOOLEAN, isSMS BOOLEAN, isEmail BOOLEAN,
    sms_from STRING, sms_media_urls STRINGS,
    email_subject STRING, email_from_name STRING, email_from_address STRING,
    email_preheader STRING, email_reply_to_address STRING,
    email_click_tracking_disabled BOOLEAN, include_unsubscribed BOOLEAN,
    include_player_ids STRINGS, include_external_user_ids STRINGS,
    include_aliases STRING, included_segments STRINGS, excluded_segments STRINGS,
    filters STRINGS,
    android_accent_color STRING, android_group STRING, android_group_message STRING,
    android_led_color STRING, android_sound STRING, android_visibility STRING,
    ios_badgeCount INT, ios_badgeType STRING, ios_category STRING,
    ios_interruption_level STRING, ios_relevance_score FLOAT, ios_sound STRING,
    ios_attachments STRINGS, apns_alert STRING_MAP,
    target_content_identifier STRING,
    chrome_big_picture STRING, chrome_icon STRING, chrome_web_icon STRING,
    chrome_web_image STRING, chrome_web_badge STRING, firefox_icon STRING,
    huawei_sound STRING, huawei_led_color STRING, huawei_accent_color STRING,
    huawei_visibility STRING, huawei_group STRING, huawei_group_message STRING,
    huawei_channel_id STRING, huawei_existing_channel_id STRING, huawei_small_icon STRING,
    huawei_large_icon STRING, huawei_big_picture STRING, huawei_msg_type STRING,
    huawei_category STRING, huawei_bi_tag STRING,
    adm_big_picture STRING, adm_group STRING, adm_large_icon STRING, adm_small_icon STRING,
    adm_sound STRING,
    spoken_text STRING, alexa_ssml STRING, alexa_display_title STRING,
    amazon_background_data STRING,
    big_picture STRING, large_icon STRING, small_icon STRING, global_image STRING,
    buttons BUTTONS,
    web_buttons STRINGS, content_available BOOLEAN, priority INT, ttl INT,
    url STRING, web_url STRING, app_url STRING, web_push_topic STRING,
    wp_sound STRING, wp_wns_sound STRING, tags STRING_MAP,
    template_id STRING, thread_id STRING, throttle_rate_per_minute INT,
    fcap_group_ids STRINGS, fcap_status STRING
    """,
    PLATFORM_STATS=T.MapType(T.StringType(), _PLATFORM_STATS),
    BUTTONS=T.ArrayType(_BUTTON),
)

ENVELOPE_METADATA = _struct(
    "batch_number INT, record_count INT, ingestion_timestamp STRING, source STRING"
)


def envelope(record: T.StructType) -> T.StructType:
    """The landing document that carries many records."""
    return T.StructType(
        [
            T.StructField("metadata", ENVELOPE_METADATA),
            T.StructField("data", T.ArrayType(record)),
        ]
    )


# --- fixed values: the message event document --------------------------------------
_ID_DATA = _struct("data ID", ID=_struct("id STRING"))
_EXTRA = _struct("""
    From City STRING, From State STRING, From Country STRING, IP Address STRING,
    Message Body STRING
""")
_EVENT_PROPERTIES = _struct(
    """
    To Number STRING, From Number STRING, Message Body STRING, Message Format STRING,
    Message Name STRING, Message Type STRING, Campaign Name STRING, Intent 1 STRING,
    Intent 1 Confidence STRING, is_spam BOOLEAN, Bot Click BOOLEAN, spam_type STRING,
    channel_type STRING, $event_id STRING, Image URL STRING, $campaign STRING,
    $message STRING, Credits INT, $usage_amount INT, Failure Type STRING, $extra EXTRA
    """,
    EXTRA=_EXTRA,
)
MESSAGE_EVENT = _struct(
    "type STRING, id STRING, attributes ATTRIBUTES, relationships RELATIONSHIPS",
    ATTRIBUTES=_struct(
        "timestamp INT, datetime STRING, uuid STRING, profile_id STRING, "
        "event_properties PROPERTIES",
        PROPERTIES=_EVENT_PROPERTIES,
    ),
    RELATIONSHIPS=_struct("metric LINK, profile LINK", LINK=_ID_DATA),
)

METRIC = _struct("type STRING, id STRING, attributes NAMED", NAMED=_struct("name STRING"))

LANDING_DAY = _struct("year INT, month STRING, day STRING")

# --- fixed values: the unified event contract (47 fields) --------------------------
UNIFIED = _struct("""
    id STRING, batch_id INT, r_created_at TIMESTAMP, r_updated_at TIMESTAMP,
    connector_id INT, source_id STRING, timestamp TIMESTAMP, source STRING,
    search_id STRING, persona STRING, profile_workspace_id STRING, user_id STRING,
    account_id STRING, provider_id STRING, session_id STRING, event_type STRING,
    campaign_id STRING, ticket_id STRING, child_event_id STRING, referrer STRING,
    ip_address STRING, user_agent STRING, name STRING, email STRING, phone STRING,
    address STRING, status STRING, channel STRING, utm_content STRING, utm_term STRING,
    utm_campaign STRING, utm_source STRING, utm_medium STRING, page_referrer STRING,
    page_title STRING, page_url STRING, unmapped STRING, device_brand STRING,
    device_model STRING, device_os STRING, device_os_version STRING, device_id STRING,
    android_id STRING, mac_address STRING, ios_ifa STRING, event_source STRING,
    event_date DATE
""")

# --- fixed values: the optimized campaign record (39 fields) -----------------------
OPTIMIZED_CAMPAIGN = (
    "opt_id", "campaign_id", "campaign_name", "raw_record_id", "batch_id",
    "sends", "delivered", "failed_count", "rejected", "total_failed", "clicks",
    "success_rate", "click_through_rate",
    "message_type", "audience_segments", "send_date", "send_datetime", "delivery_status",
    "creative_content", "creative_title", "content_text_clean",
    "has_links", "primary_link", "links_shortened", "replies",
    "recipient_count", "sending_number", "sms_metrics", "email_metrics", "push_metrics",
    "platform_stats", "processing_date", "r_created_at", "r_updated_at",
    "profile_workspace_id", "user_id", "account_id", "source", "connector_id",
)

# --- fixed values: leads and replies -----------------------------------------------
LEAD = _struct(
    """
    name STRING, phone STRING, agent_name STRING, agent_phone STRING,
    address_line_1 STRING, zip_code STRING, beds STRING, baths STRING,
    is_flexible STRING, message STRING, use_first_selection_logic BOOLEAN,
    availability AVAILABILITY
    """,
    AVAILABILITY=T.StructType([T.StructField(slot, T.StringType()) for slot in SLOTS]),
)

SENT_MESSAGE = _struct("""
    message_sid STRING, conversation_sid STRING, text_send STRING, customer_name STRING,
    sender_number STRING, received_at STRING, media_count STRING, direction STRING,
    recipient_country STRING, recipient_state STRING, sender_zip STRING,
    sender_state STRING, sender_city STRING, sender_country STRING, recipient_number STRING
""")

WEBHOOK = _struct(
    "headers STRING_MAP, body BODY",
    BODY=_struct("""
    ToState STRING, FromZip STRING, FromState STRING, FromCity STRING, FromCountry STRING,
    Body STRING, SmsMessageSid STRING, To STRING, From STRING, NumMedia STRING,
    ConversationSid STRING, MessageSid STRING, Author STRING, DateCreated STRING
    """),
)

RUN_LOG = _struct("""
    run_id STRING, job STRING, run_timestamp TIMESTAMP, status STRING,
    total_records BIGINT, start_cursor STRING, end_cursor STRING,
    metrics COUNT_MAP, error STRING
""")
