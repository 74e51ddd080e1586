"""Fixed values of the churn table: column names, service switches and their sentinel values, as the data define them."""

RENAMES = {"customerID": "CustomerID", "gender": "Gender", "tenure": "Tenure"}
KEY = "CustomerID"
DEDUP_ORDER = ["Tenure", "Gender", "MonthlyCharges"]
COLUMNS = [
    "CustomerID", "Gender", "SeniorCitizen", "Partner", "Dependents", "Tenure", "PhoneService", "MultipleLines",
    "InternetService", "OnlineSecurity", "OnlineBackup", "DeviceProtection", "TechSupport", "StreamingTV",
    "StreamingMovies", "Contract", "PaperlessBilling", "PaymentMethod", "MonthlyCharges", "TotalCharges", "Churn",
]
REQUIRED = [
    "CustomerID", "Gender", "SeniorCitizen", "Partner", "Dependents", "Tenure", "PhoneService", "InternetService",
    "Contract", "PaperlessBilling", "PaymentMethod", "MonthlyCharges", "TotalCharges", "Churn",
]
PHONE_PARENT = "PhoneService"
PHONE_CHILDREN = ["MultipleLines"]
NO_PHONE = "No phone service"
INTERNET_PARENT = "InternetService"
INTERNET_CHILDREN = ["OnlineSecurity", "OnlineBackup", "DeviceProtection", "TechSupport", "StreamingTV", "StreamingMovies"]
NO_INTERNET = "No internet service"
SENIOR = [0, 1]
NUMERIC = ["Tenure", "MonthlyCharges", "TotalCharges"]
FLOATS = ["MonthlyCharges", "TotalCharges"]
BOOLEANS = {"SeniorCitizen": 1, "Partner": "Yes", "Dependents": "Yes", "PhoneService": "Yes",
            "PaperlessBilling": "Yes", "Churn": "Yes"}
