"""DataFrame operators: shaping, joins, ordered lists, filling, date calibration."""
