"""Column functions: strings, stemming, identifiers, formulae."""
