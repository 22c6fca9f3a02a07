"""Jobs over tables: raster maths, similarity, spatial joins, point clouds, catalog."""
