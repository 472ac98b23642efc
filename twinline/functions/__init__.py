"""Column builders: character classes, filters, transforms, augmenters."""
