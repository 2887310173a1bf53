"""Hit and lookup schemas, built from a compact column spec.

A spec is whitespace-separated text.  Each entry is a column name with up to two marks:

* ``:L`` long, ``:S`` short, ``:B`` boolean, ``:T`` timestamp; no mark means string;
* a leading ``+`` adds a ``post_`` twin of the same type (the value after server-side processing);
* ``name1..9`` stands for the numbered family ``name1`` to ``name9``.

The feed orders its columns by name with digit runs compared as numbers, so the builder sorts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import types as T

# The columns of the feed's standard template, in feed order.
HIT_COLUMNS = """
accept_language browser:L browser_height:L browser_width:L c_color campaign carrier channel click_action
click_action_type:S click_context click_context_type:S click_sourceid:L click_tag code_ver color:L
connection_type:S cookies country:L ct_connect_type curr_factor:S curr_rate currency cust_hit_time_gmt:L
cust_visid daily_visitor:S date_time:T domain duplicate_events duplicate_purchase:S duplicated_from ef_id
evar1..100 event_list exclude_hit:S first_hit_page_url first_hit_pagename first_hit_referrer
first_hit_time_gmt:L geo_city geo_country geo_dma:L geo_region geo_zip hier1..5 hit_source:S hit_time_gmt:L
hitid_high hitid_low homepage hourly_visitor:S ip ip2 j_jscript java_enabled javascript:S language:L
last_hit_time_gmt:L last_purchase_num:L last_purchase_time_gmt:L mc_audiences mcvisid mobile_id:L mobileaction
mobileappid mobilecampaigncontent mobilecampaignmedium mobilecampaignname mobilecampaignsource
mobilecampaignterm mobiledayofweek mobiledayssincefirstuse mobiledayssincelastuse mobiledevice mobilehourofday
mobileinstalldate mobilelaunchnumber mobileltv mobilemessageid mobilemessageonline mobileosversion
mobilepushoptin:B mobilepushpayloadid mobileresolution monthly_visitor:S mvvar1..3 namespace new_visit:S os:L
p_plugins page_event:S page_event_var1..3 page_type page_url pagename paid_search:S partner_plugins
persistent_cookie plugins pointofinterest pointofinterestdistance post_browser_height:L post_browser_width:L
post_campaign post_channel post_cookies post_currency post_cust_hit_time_gmt:L post_cust_visid:S post_ef_id
post_evar1..100 post_event_list post_hier1..5 post_java_enabled post_keywords post_mc_audiences
post_mobileaction post_mobileappid post_mobilecampaigncontent post_mobilecampaignmedium
post_mobilecampaignname post_mobilecampaignsource post_mobilecampaignterm post_mobiledayofweek
post_mobiledayssincefirstuse post_mobiledayssincelastuse post_mobiledevice post_mobilehourofday
post_mobileinstalldate post_mobilelaunchnumber post_mobileltv post_mobilemessageid post_mobilemessageonline
post_mobileosversion post_mobilepushoptin:B post_mobilepushpayloadid post_mobileresolution post_mvvar1..3
post_page_event:S post_page_event_var1..3 post_page_type post_page_url post_pagename post_pagename_no_url
post_partner_plugins post_persistent_cookie post_pointofinterest post_pointofinterestdistance
post_product_list post_prop1..75 post_purchaseid post_referrer post_s_kwcid post_search_engine:L
post_socialaccountandappids post_socialassettrackingcode post_socialauthor post_socialcontentprovider
post_socialfbstories post_socialfbstorytellers post_socialinteractioncount post_socialinteractiontype
post_sociallanguage post_sociallatlong post_sociallikeadds post_socialmentions
post_socialowneddefinitioninsighttype post_socialowneddefinitioninsightvalue post_socialowneddefinitionmetric
post_socialowneddefinitionpropertyvspost post_socialownedpostids post_socialownedpropertyid
post_socialownedpropertyname post_socialownedpropertypropertyvsapp post_socialpageviews post_socialpostviews
post_socialpubcomments post_socialpubposts post_socialpubrecommends post_socialpubsubscribers post_socialterm
post_socialtotalsentiment post_state post_survey post_t_time_info post_tnt post_tnt_action post_transactionid
post_video post_videoad post_videoadinpod post_videoadlength post_videoadname post_videoadplayername
post_videoadpod post_videochannel post_videochapter post_videocontenttype post_videolength post_videoname
post_videoplayername post_videoqoebitrateaverageevar post_videoqoebitratechangecountevar
post_videoqoebuffercountevar post_videoqoebuffertimeevar post_videoqoedroppedframecountevar
post_videoqoeerrorcountevar post_videoqoetimetostartevar post_videosegment post_visid_high post_visid_low
post_visid_type:S post_zip prev_page:L product_list product_merchandising prop1..75 purchaseid
quarterly_visitor:S ref_domain ref_type:S referrer resolution:L s_kwcid s_resolution sampled_hit
search_engine:L search_page_num:L secondary_hit:S service socialaccountandappids socialassettrackingcode
socialauthor socialcontentprovider socialfbstories socialfbstorytellers socialinteractioncount
socialinteractiontype sociallanguage sociallatlong sociallikeadds socialmentions
socialowneddefinitioninsighttype socialowneddefinitioninsightvalue socialowneddefinitionmetric
socialowneddefinitionpropertyvspost socialownedpostids socialownedpropertyid socialownedpropertyname
socialownedpropertypropertyvsapp socialpageviews socialpostviews socialpubcomments socialpubposts
socialpubrecommends socialpubsubscribers socialterm socialtotalsentiment sourceid:L state stats_server
t_time_info tnt tnt_action tnt_post_vista transactionid truncated_hit ua_color ua_os ua_pixels user_agent
user_hash:L user_server userid:L username va_closer_detail va_closer_id:S va_finder_detail va_finder_id:S
va_instance_event:S va_new_engagement:S video videoad videoadinpod videoadlength videoadname videoadplayername
videoadpod videochannel videochapter videocontenttype videolength videoname videoplayername
videoqoebitrateaverageevar videoqoebitratechangecountevar videoqoebuffercountevar videoqoebuffertimeevar
videoqoedroppedframecountevar videoqoeerrorcountevar videoqoetimetostartevar videosegment visid_high visid_low
visid_new visid_timestamp:L visid_type:S visit_keywords visit_num:L visit_page_num:L visit_referrer
visit_search_engine:L visit_start_page_url visit_start_pagename visit_start_time_gmt:L weekly_visitor:S
yearly_visitor:S zip
"""

# Fixed values: (lookup table, hit column) pairs, in join order.
DEFAULT_ROLES: tuple[tuple[str, str], ...] = (
    ("browser", "browser"),
    ("color_depth", "color"),
    ("connection_type", "connection_type"),
    ("country", "country"),
    ("javascript_version", "javascript"),
    ("language", "language"),
    ("operating_systems", "os"),
    ("plugins", "plugins"),
    ("referrer_type", "ref_type"),
    ("referrer_type", "ref_domain"),
    ("resolution", "resolution"),
    ("search_engine", "search_engine"),
)

LOOKUP_SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType())])

_TYPES = {"": T.StringType, "L": T.LongType, "S": T.ShortType, "B": T.BooleanType, "T": T.TimestampType}
_FAMILY = re.compile(r"(.*?)(\d+)\.\.(\d+)")


def _expand(spec: str) -> Iterator[tuple[str, T.DataType]]:
    for entry in spec.split():
        name, _, mark = entry.partition(":")
        family = _FAMILY.fullmatch(name)
        if family:
            stem, low, high = family[1], int(family[2]), int(family[3])
            names = [f"{stem}{i}" for i in range(low, high + 1)]
        else:
            names = [name]
        for n in names:
            yield n, _TYPES[mark]()


def schema_from_spec(spec: str) -> T.StructType:
    """Build a nullable schema from a column spec, in the order of the spec."""
    columns = list(_expand(spec))
    if len(dict(columns)) != len(columns):
        raise ValueError("column spec names a column twice")
    return T.StructType([T.StructField(n, t) for n, t in columns])


def hit_schema() -> T.StructType:
    """The standard hit feed: 680 nullable columns."""
    return schema_from_spec(HIT_COLUMNS)
