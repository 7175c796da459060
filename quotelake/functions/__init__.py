"""Part of quotelake."""
