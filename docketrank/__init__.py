"""docketrank: messy public-register extracts in, ranked and auditable priority lists out."""

__version__ = "0.1.0"
