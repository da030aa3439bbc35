"""They must equal the published behaviour for right results."""

# Item categories, in index order; the first is the positive one.
CATEGORIES = ("good", "dead_specimen", "illustration", "screen_scan", "not_bird", "poor_quality")
DEFAULT_REJECT = ("dead_specimen", "illustration", "screen_scan", "not_bird", "poor_quality")
CORRUPTED = "corrupted"

# File extensions accepted by each family of operators.
SCORED_EXTENSIONS = ("jpg", "jpeg", "png", "webp")
MERGED_EXTENSIONS = ("jpg", "jpeg", "png", "gif", "webp")
ANNOTATED_EXTENSIONS = ("jpg", "jpeg", "png")

# Quality score weights and normalisers.
QUALITY_WEIGHTS = {"detection_score": 0.3, "bbox_pct": 0.4, "sharpness": 0.3}
SHARPNESS_NORMALIZER = 500.0
BBOX_PCT_NORMALIZER = 30.0

# Geographic boxes (lat_min, lat_max, lon_min, lon_max).
EUROPE_BOX = (35.0, 72.0, -25.0, 45.0)
FRANCE_BOX = (41.3, 51.1, -5.1, 9.6)

# Photo eligibility and auto-relax.
MIN_PHOTO_WIDTH = 400
MIN_PHOTO_HEIGHT = 400
RELAX_BELOW = 50
RELAXED_POSITION = 2
MIN_OBSERVATIONS = 50
CLADE_ID = 3

# Labels served from the inner geographic box first.
PRIORITY_LABELS = (
    "Aegithalos caudatus",
    "Carduelis carduelis",
    "Chloris chloris",
    "Coloeus monedula",
    "Columba livia",
    "Columba palumbus",
    "Corvus corone",
    "Cyanistes caeruleus",
    "Erithacus rubecula",
    "Fringilla coelebs",
    "Parus major",
    "Passer domesticus",
    "Periparus ater",
    "Pica pica",
    "Prunella modularis",
    "Streptopelia decaocto",
    "Sturnus vulgaris",
    "Troglodytes troglodytes",
    "Turdus merula",
    "Turdus philomelos",
)

# Model architectures, best first, with their display names.
ARCH_RANK = ("vit_b_16", "efficientnetv2_b2", "efficientnet_b0", "mobilenetv2")
ARCH_DISPLAY = {
    "mobilenetv2": "MobileNetV2",
    "efficientnet_b0": "EfficientNet-B0",
    "efficientnetv2_b2": "EfficientNetV2-B2",
    "vit_b_16": "ViT-B/16",
}

# Composite-score thresholds tried by the sweep.
SWEEP_THRESHOLDS = (0.05, 0.1, 0.15, 0.2, 0.25, 0.3, 0.4)
DEFAULT_THRESHOLD = 0.2
BORDERLINE_CENTER = 0.3

SPLITS = ("train", "validation", "test")
