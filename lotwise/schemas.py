"""Row types of the tables this package reads and writes, as DDL."""

MONEY = "decimal(18,2)"


LINEAGE = "s3_key string, http_status int, parser_version string"

RAW_PAGE = f"source string, url string, html string, fetched_at timestamp, {LINEAGE}"

SUMMARY = (
    "source string, source_listing_key string, url string, is_ad boolean, category_id string, domain_id string, title_raw string,"
    f" price_amount {MONEY}, price_currency string, attributes_raw array<string>, location_raw string, financing_initial_payment string,"
    f" discovered_at timestamp, {LINEAGE}"
)

DETAIL = (
    "source string, source_listing_key string, url string, brand_raw string, color string, fuel_type_raw string, number_of_doors string,"
    f" transmission_raw string, item_condition string, price_amount {MONEY}, price_currency string, price_valid_until string,"
    " breadcrumb_raw string, subtitle_raw string, location_raw string, highlighted_specs_raw array<string>, seller_name string,"
    " seller_type string, seller_id bigint, province_raw string, item_status string, financing_initial_payment string,"
    f" fetched_at timestamp, {LINEAGE}"
)

QUARANTINE = "s3_key string, url string, reason string"

# What is read of the embedded JSON. Fields of varying shape are strings: they keep their JSON text.

CARD = "struct<metadata:struct<id:string,url:string,is_pad:string,category_id:string,domain_id:string>,components:array<map<string,string>>>"

LISTING_CONTEXT = (
    "appProps struct<sharedState:struct<search:struct<"
    f"results:array<struct<id:string,polycard:{CARD},items:array<struct<id:string,polycard:{CARD}>>>>,"
    "pagination:struct<pagination_nodes_url:array<string>>>>>"
)

PAGE_NODE = "value string, url string, is_actual_page boolean"

VEHICLE = (
    "sku string, brand string, color string, fuelType string, numberOfDoors string, vehicleTransmission string, itemCondition string,"
    f" offers struct<price:{MONEY},priceCurrency:string,priceValidUntil:string>"
)

BREADCRUMB = "itemListElement array<struct<position:string,name:string,item:struct<name:string>>>"

DETAIL_CONTEXT = (
    "appProps struct<pageProps:struct<initialState:struct<components:struct<"
    "header:struct<subtitle:string>,"
    "item_proximity:struct<content_rows:array<struct<label:struct<text:string>>>>,"
    "highlighted_specs_attrs:struct<components:array<string>>,"
    "initial_payment_amount:struct<title:struct<text:string>>,"
    "seller_card_motors:string,seller_profile:string,"
    "track:struct<melidata_event:struct<event_data:struct<seller_id:bigint,state:string,item_status:string>>>>>>>"
)

DEALER_CARD = (
    "seller_name struct<title:struct<text:string>>,"
    " phone_link struct<track:struct<melidata_event:struct<event_data:struct<item_seller_type:string>>>>"
)
