"""Expected values of the policy, written down apart from the engine.

The SQL equivalents and the test model read these tables, so a wrong value in the engine's
configuration shows up as a difference.
"""

# Severity of payment-status codes.
PAYMENT_CODES = {
    "000": 0, "01+": 1, "30+": 2, "60+": 3, "90+": 4, "120+": 5, "180+": 6, "360+": 7, "540+": 8,
    "720+": 9, "PWOS": 10, "RGM": 11, "SET": 12, "WOF": 13, "BK": 14, "RES": 15, "SPM": 16,
    "WDF": 17, "SF": 18, "SUB": 19, "DBT": 20, "CUF": 21, "CLSD": -1, "INAC": -3, "ADJ": -4,
    "STD": -5, "LOSS": -6, "RNC": -7, "LNSB": -8, "FPD": -9, "DIS": -12, "LAND": -13, "DEC": -15,
    "NEW": -17,
}

# Level of suit-filed codes.
SUIT_CODES = {"NS": -3, "*": -2, "SF": 1, "TP": 9, "DI": 10, "ED": 11}

# Level of asset-classification codes.
ASSET_CODES = {
    "STD": 1, "SUB": 2, "DBT": 3, "LOSS": 4, "SMA": 5, "NPA": 6, "SMA 0": 7, "SMA 1": 8, "SMA 2": 9,
    "DBT 1": 10, "DBT 2": 11, "DBT 3": 12,
}

# Score bands, income brackets and the three limit grids.
SCORE_BANDS = (("A", 900), ("B", 800), ("C", 700), ("D", 600), ("E", 500), ("F", 400))
INCOME_BRACKETS = (
    (0, 0, 1), (0, 10000, 1), (10000, 25000, 2), (25000, 30000, 2), (30000, 40000, 3),
    (40000, 50000, 3), (50000, None, 4),
)
LIMIT_MULTIPLIER = {
    "A": (1.15, 1.15, 1.25, 1.5), "B": (1.0, 1.0, 1.15, 1.25), "C": (0.8, 1.0, 1.15, 1.15),
    "D": (0.8, 0.8, 1.0, 1.15), "E": (0.75, 0.8, 1.0, 1.0), "F": (0.75, 0.75, 0.8, 1.0),
    "G": (0.65, 0.65, 0.75, 0.75),
}
LIMIT_CEILING = {
    "A": (1000, 2000, 3000, 4000), "B": (750, 1500, 2000, 3000), "C": (750, 1000, 1500, 2500),
    "D": (750, 1000, 1000, 2500), "E": (500, 750, 1000, 1500), "F": (500, 500, 750, 1000),
    "G": (500, 500, 500, 750),
}
LIMIT_FLOOR = {
    "A": (300, 500, 750, 1000), "B": (300, 500, 750, 1000), "C": (300, 500, 750, 750),
    "D": (300, 300, 500, 500), "E": (300, 300, 500, 500), "F": (300, 300, 300, 300),
    "G": (300, 300, 300, 300),
}
