import pytest

from martloom.functions.channels import with_channel

# landing, referrer, source, medium -> roi, profile, attribution, basic
CASES = [
    ("/", None, "klaviyo", "email", "email_klaviyo", "email_klaviyo", "email_klaviyo", "email_klaviyo"),
    ("/?utm_source=klaviyo", None, None, None, "email_klaviyo", "email_klaviyo", "email_klaviyo", "direct"),
    (None, None, "google", "cpc", "google_paid", "google_paid", "google_paid", "google_paid"),
    (None, None, "google", "dg", "google_paid", "google_paid", "google_paid", "other"),
    (None, None, "google", "pmx", "other", "google_paid", "google_paid", "other"),
    (None, None, "meta", "paid", "meta_paid", "meta_paid", "meta_paid", "other"),
    (None, None, "ig.me", "social", "other", "meta_paid", "meta_paid", "other"),
    (None, None, "facebook", "cpc", "meta_paid", "meta_paid", "meta_paid", "meta_paid"),
    (None, None, "yahoo", "cpc", "yahoo_paid", "yahoo_paid", "yahoo_paid", "yahoo_paid"),
    (None, None, "yahoo", "dsa", "other", "yahoo_paid", "yahoo_paid", "other"),
    (None, None, "bing", "paid", "microsoft_paid", "microsoft_paid", "microsoft_paid", "microsoft_paid"),
    ("/", "https://l.instagram.com/", None, None, "instagram_organic", "instagram_organic", "instagram_organic", "instagram_organic"),
    ("/", "https://www.google.com/", None, None, "seo_google", "seo_google", "seo_google", "seo_google"),
    ("/", "https://search.yahoo.co.jp/", None, None, "seo_yahoo", "seo_yahoo", "seo_yahoo", "seo_yahoo"),
    ("/", "https://www.bing.com/", None, None, "other", "seo_bing", "seo_bing", "other"),
    ("/", "https://youtube.com/", None, None, "social_youtube", "social_youtube", "social_youtube", "other"),
    # tags only in the landing page: the untagged branches of the customer reports do not see them
    ("/?utm_source=news&utm_medium=email", "https://www.google.com/", None, None, "other", "seo_google", "seo_google", "seo_google"),
    ("/?utm_source=news&utm_medium=email", None, None, None, "other", "direct", "direct", "direct"),
    (None, None, None, None, "direct", "direct", "unknown", "direct"),
    ("/", None, None, None, "direct", "direct", "direct", "direct"),
    ("/", "https://example.org/", None, None, "other", "other", "other", "other"),
]


@pytest.mark.parametrize("place,variant", list(enumerate(("roi", "profile", "attribution", "basic"))))
def test_every_rule(spark, place, variant):
    data = [(i, *c[:4], c[4 + place]) for i, c in enumerate(CASES)]
    df = spark.createDataFrame(
        data, "i int, landing_site string, referring_site string, utm_source string, utm_medium string, want string"
    )
    wrong = with_channel(df, variant).filter("channel <> want").collect()
    assert wrong == []
