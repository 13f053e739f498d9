"""Part of skysift."""
