"""Fixed values of segments that all parts share."""

# fixed values: entry types, their short forms, and what is said where nothing continues
TYPES = ("directory_entry", "ad_block", "category_heading")
SHORT_TYPES = {"d": "directory_entry", "a": "ad_block", "h": "category_heading"}
NO_CONTINUITY = {"sameEntry": False, "previousSegmentId": "", "mergedCleanText": "", "confidence": 0.0, "reason": ""}
