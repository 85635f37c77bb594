"""Column roles, thresholds, seeds and the rule tables (driver-side constants)."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Roles:
    """Which columns play which part. Any table works once its columns are mapped to roles."""

    id: str
    category: str
    features: tuple[str, ...]
    label: str | None = None
    # which feature feeds which business band (age-like, income-like, spending-like)
    age_feature: str | None = None
    income_feature: str | None = None
    spending_feature: str | None = None
    # features that hold money with 2 decimals: their means are taken over exact integer cents
    # (order-independent, so every engine and every partitioning gives the same bits)
    money: tuple[str, ...] = ()


@dataclass(frozen=True)
class Bands:
    """Two cut points per band: value < lo -> first name, < hi -> second, else third."""

    age: tuple[float, float] = (30.0, 50.0)
    income: tuple[float, float] = (500000.0, 1000000.0)
    spending: tuple[float, float] = (40.0, 70.0)


@dataclass(frozen=True)
class SegmentationConfig:
    k_range: tuple[int, ...] = tuple(range(2, 11))
    seed: int = 42
    kmeans_max_iter: int = 300
    kmeans_restarts: int = 10
    gmm_max_iter: int = 200
    knn_k: int = 10
    knn_percentile: float = 0.90
    histogram_bins: int = 30
    outlier_iqr: float = 3.0
    scatter3d_sample: int = 1000
    ward_micro_clusters: int = 256
    bands: Bands = field(default_factory=Bands)


# The layout of the original customer file.
CUSTOMER_ROLES = Roles(
    id="CustomerID",
    category="Gender",
    features=("Age", "Annual Income (BDT)", "Spending Score (1-100)"),
    label="True_Segment",
    age_feature="Age",
    income_feature="Annual Income (BDT)",
    spending_feature="Spending Score (1-100)",
)

# Role mapping of the bundled test tables: customer LEFT JOIN orders (one row per customer).
FEATURE_ROLES = Roles(
    id="c_custkey",
    category="c_mktsegment",
    features=("c_acctbal", "order_count", "total_spend"),
    label="c_mktsegment",
    age_feature="c_acctbal",
    income_feature="total_spend",
    spending_feature="order_count",
    money=("c_acctbal", "total_spend"),
)

# Band cut points for the test tables (near the quartiles so that every band is hit).
FEATURE_BANDS = Bands(age=(2000.0, 7000.0), income=(1800000.0, 3000000.0), spending=(8.0, 12.0))

# ---------------------------------------------------------------------------------------------
# FIXED VALUES — must equal the original job's outputs; kept here as plain data, in their
# natural order. Rules are (conditions, outputs); the first rule whose conditions hold wins.
# A condition is a tuple of allowed band names (None = any); "share_gt" is a strict bound on
# the cluster's percentage of all rows.
# ---------------------------------------------------------------------------------------------

AGE_NAMES = ("Young", "Middle-aged", "Senior")
INCOME_NAMES = ("Low", "Medium", "High")
SPENDING_NAMES = ("Low", "Medium", "High")

ALGORITHMS_BATCH = ("KMeans", "Hierarchical", "DBSCAN", "GMM")

# batch marketing strategy
STRATEGY_RULES = (
    ({"spending": ("High",), "income": ("High",)}, "Premium products, VIP programs, exclusive offers, personalized service"),
    ({"spending": ("High",)}, "Value bundles, loyalty rewards, installment plans, quality assurance"),
    ({"spending": ("Low",), "income": ("High",)}, "Trust-building campaigns, product demonstrations, value propositions"),
    ({"spending": ("Medium",), "share_gt": 20.0}, "Mass market campaigns, seasonal promotions, volume discounts"),
    ({}, "Entry-level products, first-purchase discounts, education campaigns"),
)

# batch product recommendations: (product, priority, reason, conversion)
PRODUCT_RULES_BATCH = (
    ({"income": ("High",), "spending": ("High",)}, (
        ("iPhone Pro Max", "🔴 Primary", "Premium segment with high purchasing power", "85-90%"),
        ("MacBook Pro", "🔴 Primary", "Affluent professionals seeking premium quality", "75-80%"),
    )),
    ({"income": ("High",)}, (
        ("HP Business Laptop", "🟡 Primary", "Value-conscious professionals", "70-75%"),
        ("Bluetooth Speaker", "🟢 Secondary", "Low-risk entry point", "55-60%"),
    )),
    ({"income": ("Medium",), "spending": ("High",)}, (
        ("HP Mid-Range Laptop", "🔴 Primary", "Aspirational buyers, offer financing", "75-80%"),
        ("Wireless Headphones", "🟡 Primary", "Lifestyle accessory within budget", "70-75%"),
    )),
    ({}, (
        ("Headphones", "🔴 Primary", "Essential accessory at accessible price", "80-85%"),
        ("Bluetooth Speaker", "🟡 Primary", "Entry-level lifestyle product", "75-80%"),
    )),
)

# interactive recommendation text and priority
PRIORITY_RULES = (
    ({"spending": ("High",), "income": ("High",)}, ("Premium products, VIP programs, exclusive offers, personalized service", "🔴 High")),
    ({"spending": ("High",), "income": ("Medium", "Low")}, ("Value bundles, loyalty rewards, quality products at competitive prices", "🟡 Medium")),
    ({"spending": ("Low",), "income": ("High",)}, ("Trust-building campaigns, product demonstrations, value proposition focus", "🟡 Medium")),
    ({}, ("Standard campaigns, seasonal promotions, volume discounts", "🟢 Low")),
)

# interactive product recommendations: (product, price, conversion, priority, reason, strategy)
PRODUCT_RULES_INTERACTIVE = (
    ({"income": ("High",), "spending": ("High",)}, (
        ("📱 iPhone Pro Max", "BDT 140,000 - 180,000", "High (75-85%)", "🔴 Primary Target",
         "High purchasing power with willingness to spend on premium products.",
         "VIP early access, exclusive events, premium service packages"),
        ("💻 MacBook Pro", "BDT 180,000 - 280,000", "High (70-80%)", "🔴 Primary Target",
         "Professional segment seeking premium productivity tools.",
         "B2B partnerships, corporate bundles, professional support"),
    )),
    ({"income": ("High",), "spending": ("Low", "Medium")}, (
        ("🖥️ HP Business Laptop", "BDT 65,000 - 95,000", "High (70-80%)", "🔴 Primary Target",
         "Value-conscious despite high income. Seeks quality at reasonable prices.",
         "Emphasize ROI, durability, warranty, customer reviews"),
    )),
    ({"income": ("Low", "Medium"), "spending": ("High",)}, (
        ("🖥️ HP Mid-Range Laptop", "BDT 45,000 - 70,000", "High (75-85%)", "🔴 Primary Target",
         "Aspirational but affordable. EMI options make it accessible.",
         "Flexible payment plans, 0% EMI, student discounts"),
        ("🎧 Wireless Headphones", "BDT 3,000 - 8,000", "High (70-80%)", "🔴 Primary Target",
         "Lifestyle accessory within budget with perceived value.",
         "Social media campaigns, influencer marketing, cashback offers"),
    )),
    ({}, (
        ("🎧 Budget Headphones", "BDT 1,500 - 3,500", "High (75-85%)", "🔴 Primary Target",
         "Essential accessory at accessible price point.",
         "Affordability focus, quality assurance, first-buyer incentives"),
        ("🔊 Basic Bluetooth Speaker", "BDT 1,800 - 3,500", "Medium (65-75%)", "🟡 Secondary Target",
         "Entry-level lifestyle product with volume sales potential.",
         "Volume discounts, festival bonanzas, flash sales"),
    )),
)

# demographic insight by age band (unknown band -> Middle-aged): (demographic, behavior, approach)
DEMOGRAPHICS = {
    "Young": ("Young Adults (18-30 years)",
              "Tech-savvy, trend-conscious, social media active, value experiences",
              "Digital-first marketing, influencer partnerships, mobile campaigns"),
    "Middle-aged": ("Middle-aged Adults (30-50 years)",
                    "Career-focused, family-oriented, value quality and reliability",
                    "Multi-channel marketing, emphasize value and quality, email campaigns"),
    "Senior": ("Senior Adults (50+ years)",
               "Experience-rich, budget-conscious, prefer personal service",
               "Traditional marketing mix, customer service focus, loyalty programs"),
}
DEFAULT_DEMOGRAPHIC = "Middle-aged"

# action plan by priority level: (level, expected impact, timeline, revenue potential)
ACTION_PLAN = (
    ("High", "High", "3-6 months", "High"),
    ("Medium", "Moderate", "6-12 months", "Moderate"),
    ("Low", "Low", "Ongoing maintenance", "Low"),
)

# budget allocation: (priority, budget percent, reason)
BUDGET = (
    ("High Priority", 50, "Maximum ROI focus"),
    ("Medium Priority", 35, "Optimization efforts"),
    ("Low Priority", 15, "Maintenance campaigns"),
)
