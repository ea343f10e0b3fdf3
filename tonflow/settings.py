"""Business parameters, all overridable through :class:`Settings`."""

from __future__ import annotations

from dataclasses import dataclass, field

# --- Fixed values -----------------------------------------------------------------
# Codes, names, shares and thresholds an existing deployment relies on.  They are data,
# not logic: keep them in this order and override them with ``Settings(...)``.

CONTRACTORS = {
    "GEC": "PT Goden Energi Cemerlang Lestari",
    "KMB": "KSU Mitra Bersatu",
    "BMT": "PT Bumiputera Maha Terpecaya",
    "RBT": "PT Rezki Batulicin Transport",
    "BBS": "PT Borneo Banua Sejahtera",
    "MMS": "PT Makmur Mulya Sebamban",
    "MAV": "PT. Multi Adverindo",
    "AEK": "PT Anugrah Energi Kalimantan",
    "BKA": "PT Barajasa Kalimantan Abadi Energi",
    "RAM": "PT Rizky Aulia Mandiri",
    "RAMB": "PT Rizky Aulia Mandiri",
    "TMR": "PT. Tama Mulia Resources",
    "EST": "PT Energi Sinar Tambang",
    "PDT": "PT Pandu Dwi Tunggal",
}
STOCKPILE_FLEETS = ("TMR", "PDT", "EST")

ROM_SHARES = {
    "ROM-A1": 0.28,
    "ROM-A2": 0.25,
    "ROM-A3": 0.20,
    "ROM-B1": 0.17,
    "ROM-B2": 0.06,
    "PIT-C-APL": 0.04,
}

MONTH_TARGETS = {"2026-07": 1_500_000.0, "2026-08": 1_550_000.0}

# Funnel stages: sequence, code, label, branch.
FUNNEL_STAGES = (
    (1, "ROM_PRODUCTION", "ROM Production", "MAIN"),
    (2, "HAULING_WEIGHED", "Hauling (WIM/Ucan)", "MAIN"),
    (3, "HAULING_DIRECT_CP", "Direct ROM -> CP", "DIRECT"),
    (4, "STOCKPILE_IN", "Stockpile IN", "BUFFER"),
    (5, "STOCKPILE_OUT", "Stockpile OUT/Reclaim", "BUFFER"),
    (6, "CP_INTAKE", "Crushing Plant Intake", "MAIN"),
    (7, "SHIPMENT", "Shipment", "MAIN"),
)

# Reconciled stage pairs: upstream, downstream, label, kind of gap.
STAGE_PAIRS = (
    ("ROM_PRODUCTION", "HAULING_WEIGHED", "Muat ROM vs Timbang", "MEASUREMENT_GAP"),
    ("HAULING_WEIGHED", "CP_INTAKE", "Timbang vs Intake CP", "TRANSPORT_LOSS"),
    ("STOCKPILE_IN", "STOCKPILE_OUT", "Stockpile IN vs OUT", "BUFFER_CHANGE"),
    ("CP_INTAKE", "SHIPMENT", "Intake CP vs Shipment", "PROCESS_RECOVERY"),
)

OWNERS_BY_CATEGORY = {
    "BALANCING": "Pengawas Hauling / Manajer Produksi",
    "LOSS": "Manajer Produksi / Manajer Quality",
    "SHIPMENT": "Tim Perencanaan / Tim Shipping",
    "STOCKPILE": "Manajer Crushing Plant",
    "THROUGHPUT": "Manajer Crushing Plant",
    "DATA_QUALITY": "Tim Data / IT Operasional",
}
DEFAULT_OWNER = "Manajer Produksi"

# Crushing plants by equipment-log id, and the belt each plant feeds directly.
PLANT_BY_ID = {
    1: "CP1", 2: "CP2", 3: "CP3", 4: "CP4", 5: "CP5",
    6: "CP6", 7: "CP7", 8: "CP8", 9: "CP9", 11: "CP2New",
}
PLANT_BELTS = {"CP1": "CV14", "CP6": "CV22", "CP7": "CV12", "CP8": "CV105", "CP9": "CV106"}
DIRECT_BELTS = ("CV14", "CV22", "CV12", "CV105", "CV106", "CV107", "CV116")
RECLAIM_BELTS = ("CV15A", "CV15B", "CV23A", "CV23B")
CHAIN_FEEDERS = (
    "CP1_CHAIN_FEEDER_STATUS_EQ",
    "CP9_CHAIN_FEEDER_STATUS_EQ",
    "CP3_CHAIN_FEEDER_STATUS_CONTROL",
    "CP2A_CHAIN-FEEDER.FEEDER_ANIMATION",
    "CP4_Chain_Feeder",
    "CHAIN_FEEDER_STATUS",
    "CHAIN_FEEDER_STATUS_EQ",
)
FEEDER_BREAKERS = (
    "CP1_FEEDER_BREAKER_STATUS_EQ",
    "CP9_FEEDER_BREAKER_STATUS_EQ",
    "CP3_FEEDER_BREAKER_STATUS_CONTROL",
    "CP2A_FEEDER-BREAKER.BREAKER_ANIMATION",
    "CP4_Feeder_Breaker",
    "FEEDER_BREAKER_STATUS",
    "FEEDER_BREAKER_STATUS_EQ",
)
# --- end of fixed values ------------------------------------------------------------


@dataclass(frozen=True)
class Settings:
    """Thresholds and conventions; the defaults are the fixed values above."""

    # time
    timezone: str = "Asia/Makassar"
    day_start_hour: int = 6
    shift_hours: int = 12
    day_shift: str = "Pagi"
    night_shift: str = "Malam"
    # units
    kg_per_ton: float = 1000.0
    density: float = 0.88
    reading_seconds: float = 30.0
    # loss and payload
    loss_warn_pct: float = 2.0
    loss_critical_pct: float = 5.0
    payload_min_ton: float = 25.0
    payload_max_ton: float = 80.0
    # matching
    match_hours: float = 8.0
    match_slot_minutes: float = 60.0
    # stockpile
    opening_stock_ton: float = 0.0
    min_cover_days: float = 1.5
    # balancing and anomalies
    imbalance_pct: float = 15.0
    z_threshold: float = 3.0
    z_critical_factor: float = 1.67
    mad_constant: float = 0.6745
    # targets
    month_target_ton: float = 1_500_000.0
    month_targets: dict = field(default_factory=lambda: dict(MONTH_TARGETS))
    rom_shares: dict = field(default_factory=lambda: dict(ROM_SHARES))
    recovery_factor: float = 0.985
    # belts against weighbridge
    belt_tolerance: float = 0.05
    # master data
    contractors: dict = field(default_factory=lambda: dict(CONTRACTORS))
    stockpile_fleets: tuple = STOCKPILE_FLEETS
    owners: dict = field(default_factory=lambda: dict(OWNERS_BY_CATEGORY))
    stages: tuple = FUNNEL_STAGES
    stage_pairs: tuple = STAGE_PAIRS
    plants: dict = field(default_factory=lambda: dict(PLANT_BY_ID))
    plant_belts: dict = field(default_factory=lambda: dict(PLANT_BELTS))
    direct_belts: tuple = DIRECT_BELTS
    reclaim_belts: tuple = RECLAIM_BELTS
    chain_feeders: tuple = CHAIN_FEEDERS
    feeder_breakers: tuple = FEEDER_BREAKERS
    # suggestions
    top_suggestions: int = 3


DEFAULTS = Settings()
