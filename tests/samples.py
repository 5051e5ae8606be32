"""A valid prediction request."""

REQUEST = {
    "hour": 17,
    "junction": 4,
    "car_count": 61,
    "bike_count": 12,
    "bus_count": 7,
    "truck_count": 9,
    "traffic_volume": 6100,
    "air_pollution_index": 88,
    "humidity": 41,
    "visibility_in_miles": 6,
    "temperature": 281.5,
    "rain_p_h": 0.0,
    "snow_p_h": 0.5,
    "weather_type": "Snow",
    "weather_description": "light snow",
    "day_of_week": "Friday",
}
