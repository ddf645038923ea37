"""Finding records of the same customer and merging them."""
